import datetime
import json
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from barloom.schemas import BARS  # noqa: E402
from barloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8",
        **{
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": tmp_path_factory.mktemp("events").as_uri(),
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def executed(spark):
    """A function that gives the plans of all that ran since the test began, as Spark's event log has them."""
    folder = pathlib.Path(spark.conf.get("spark.eventLog.dir").removeprefix("file://").removeprefix("file:"))
    (log,) = folder.iterdir()
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    begin = log.stat().st_size

    def plans():
        bus.waitUntilEmpty()
        with log.open("rb") as lines:
            lines.seek(begin)
            events = map(json.loads, lines)
            return [event["physicalPlanDescription"] for event in events if "physicalPlanDescription" in event]

    return plans


@pytest.fixture
def make_bars(spark):
    """Bars from (symbol, "yyyy-mm-dd", open_c, high_c, low_c, close_c, volume) rows."""

    def build(rows):
        return spark.createDataFrame(
            [(r[0], datetime.date.fromisoformat(r[1]), *r[2:]) for r in rows], BARS
        )

    return build


def by_key(df, column, *keys):
    """{key: value} of one column; the key is the day unless named."""
    keys = keys or ("trade_date",)
    rows = df.collect()
    found = {tuple(row[k] for k in keys): row[column] for row in rows}
    assert len(found) == len(rows)
    return found


def values(df, column):
    """One symbol's column in day order."""
    return [row[column] for row in df.orderBy("trade_date").collect()]
