"""Bars as known on a past day, and files that name their columns, against replays."""

import datetime
import random

import pytest
from conftest import by_key
from pyspark.sql import functions as F
from test_plans import plan_of

from barloom.operators import bitemporal, history, quality
from barloom.schemas import BAR_COLUMNS, BAR_VALUES, BARS
from barloom.sources import price_csv
from barloom.streaming import daily_ingest, known_history

FETCHED = BARS.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", fetch_date date"


def day(n):
    return datetime.date(2020, 1, 1) + datetime.timedelta(days=n)


def fetches(n, seed):
    """Bars of a few days, some restated, taken back to an earlier state or fetched unchanged, some twice on a date."""
    random.seed(seed)
    rows = []
    for _ in range(n):
        close = random.choice([100, 100, 100, 110, 120])
        rows.append((random.choice("AB"), day(random.randrange(4)), 100, 130, 90, close, 5, random.choice([None, *map(day, range(10, 40, 3))])))
    return rows


def replay(rows, when):
    """{(symbol, day): close} of the newest fetch up to a date; of one date's, the least values."""
    found = {}
    for symbol, date, *values, fetched in rows:
        if fetched is not None and fetched <= when:
            key, rank = (symbol, date), (-(fetched - day(0)).days, values)
            found[key] = min(found.get(key, rank), rank)
    return {key: rank[1][3] for key, rank in found.items()}


def seen(known, when):
    return by_key(bitemporal.as_known(known, when), "close_c", "symbol", "trade_date")


def test_any_past_day_equals_a_replay(spark):
    rows = fetches(300, 51)
    known = bitemporal.versions(spark.createDataFrame(rows, FETCHED).repartition(4)).cache()
    for n in range(8, 45):
        assert seen(known, day(n)) == replay(rows, day(n)), n
    # No state is repeated, and each ends where the next begins.
    states = {}
    for r in known.orderBy("known_from").collect():
        own = states.setdefault((r.symbol, r.trade_date), [])
        if own:
            assert own[-1].known_to == r.known_from and tuple(own[-1][:7]) != tuple(r[:7])
        own.append(r)
    assert all(own[-1].known_to is None for own in states.values())
    assert known.count() < len({(r[0], r[1], r[7]) for r in rows if r[7]})
    empty = bitemporal.versions(spark.createDataFrame([], FETCHED))
    assert empty.count() == 0 and empty.columns == [f.name for f in bitemporal.VERSIONS]
    changed = bitemporal.revisions(known)
    assert changed.count() == sum(len(own) - 1 for own in states.values()) and changed.where("days_held <= 0").count() == 0


def test_versions_extended_day_by_day_equal_those_made_at_once(spark):
    rows = [r for r in fetches(200, 52) if r[7] is not None]
    df = spark.createDataFrame(rows, FETCHED)
    known = bitemporal.versions(df.limit(0))
    for fetched in sorted({r[7] for r in rows}):
        known = spark.createDataFrame(bitemporal.extend(known, df.where(F.col("fetch_date") == fetched)).collect(), bitemporal.VERSIONS)
    want = sorted(map(str, bitemporal.versions(df).collect()))
    assert sorted(map(str, known.collect())) == want
    plan = plan_of(bitemporal.as_known(known, day(3)))
    assert "Exchange" not in plan and "Window" not in plan


def test_stored_history_on_any_day_equals_a_replay_of_the_files(spark, tmp_path):
    """Runs in the order of their dates, one that is late, one that brings the same date again, one of other years only."""
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    random.seed(53)
    days = [datetime.date(2020, 12, 30), datetime.date(2020, 12, 31), datetime.date(2021, 1, 4), datetime.date(2019, 5, 1)]
    held = []
    for run, (fetched, dates) in enumerate([(10, days[:2]), (20, days[:3]), (15, days[:2]), (20, days[2:3]), (30, days[3:]), (30, days[:1])]):
        rows = [(s, d, 100, 130, 90, random.choice([100, 110, 120]), 5, day(fetched)) for s in "AB" for d in dates]
        held += [(run, r) for r in rows]
        price_csv.write_prices(spark.createDataFrame(rows, FETCHED).coalesce(1), files)
        daily_ingest.run_daily(spark, files, store, day(fetched))
        known_history.refresh_known(spark, store)
        if run == 1:
            known_history.refresh_known(spark, store)  # nothing new
        stored = daily_ingest.read_rows(spark, store).where("is_ok").select(
            "symbol", "trade_date", "source_file", (F.col("close") * 100).cast("bigint").alias("close_c"), "fetch_date"
        ).collect()
        for n in (9, 10, 17, 20, 99):
            found = {}
            for r in stored:
                if r.fetch_date <= day(n):
                    rank = (-(r.fetch_date - day(0)).days, r.source_file, r.close_c)
                    found[r.symbol, r.trade_date] = min(found.get((r.symbol, r.trade_date), rank), rank)
            got = by_key(known_history.read_known(spark, store, day(n)), "close_c", "symbol", "trade_date")
            assert got == {key: rank[2] for key, rank in found.items()}, (run, n)
    newest = by_key(daily_ingest.read_history(spark, store), "close_c", "symbol", "trade_date")
    assert newest == by_key(known_history.read_known(spark, store, day(99)), "close_c", "symbol", "trade_date")
    assert known_history.read_known(spark, str(tmp_path / "none"), day(99)).count() == 0


# columns by name

ORDERS = [
    None,
    {"Volume": "volume", "close": "close", " Date ": "trade_date", "open": "open", "high": "high", "low": "low"},
    {"timestamp": "trade_date", "open": "open", "high": "high", "adj": "low", "low": "low", "close": "close", "volume": "volume"},
]


def many_bars(make_bars):
    rows = []
    for s in "ABCDEF":
        for i in range(1, 15):
            rows.append((s, f"2024-03-{i:02d}", 100 + i, 150, 90, 110 + i, i))
    return make_bars(rows).withColumn("fetch_date", F.lit(day(0)))


def test_files_of_several_orders_equal_sorted_ones(spark, make_bars, tmp_path):
    bars = many_bars(make_bars)
    path, alike = str(tmp_path / "mixed"), str(tmp_path / "alike")
    for i, columns in enumerate(ORDERS):
        price_csv.write_prices(bars.where(F.pmod(F.ascii("symbol"), F.lit(3)) == i), path, columns)
    price_csv.write_prices(bars, alike, ORDERS[1])
    for folder in (path, alike):
        rows = price_csv.read_named(spark, folder)
        assert rows.where("not header_ok or _bad is not null").count() == 0
        good, _ = quality.validate(rows, ["source_file"], ["fetch_date"])
        assert sorted(map(tuple, quality.to_bars(good).collect())) == sorted(map(tuple, bars.select(BAR_COLUMNS).collect()))
    assert "Join" in plan_of(price_csv.read_named(spark, path)) and "Join" not in plan_of(price_csv.read_named(spark, alike))


@pytest.mark.parametrize(
    "text, reasons",
    [
        ("close,open,high,low,volume,date\n11,10,12,9,5,2024-01-02\n", [[]]),
        ('"close","open","high","low","volume","date"\r\n"11","10","12","9","5","2024-01-02"\r\n', [[]]),
        ('note,date,open,high,low,close,volume\n"a, b",2024-01-02,10,12,9,11,5\n', [[]]),
        ("date,open,high,low,close,volume\n2024-01-02,10,12,9,11,5,6\n2024-01-03,10,12,9,11\n", [["unparsable"]] * 2),
        ("date,open,high,low,close,volume\n2024-01-02,x,12,9,11,5\n\n2024-01-03,,12,9,11,5\n", [["null_price"], ["unparsable"]]),
        ("2024-01-02,10,12,9,11,5\n", [["bad_header"]]),
        ("date,open,high,low,close\n2024-01-02,10,12,9,11\n", [["bad_header"]] * 2),
        ("date,open,open,high,low,close,volume\n", [["bad_header"]]),
        ("date,open,high,low,close,volume\n2024-01-02,10,12,9,11,5\nclose,open,high,low,volume,date\n", [["bad_header"]]),
        ('{"message": "no data"}\n', [["bad_header"]]),
    ],
)
def test_odd_files_by_name(spark, tmp_path, text, reasons):
    folder = tmp_path / "fetch_date=2024-02-01" / "symbol=A"
    folder.mkdir(parents=True)
    (folder / "one.csv").write_text(text)
    rows = price_csv.read_named(spark, str(tmp_path))
    checked = quality.classify(rows, ["source_file"], ["fetch_date"]).collect()
    assert sorted(r.reasons for r in checked) == sorted(reasons)
    if reasons == [[]]:
        (row,) = checked
        assert (str(row.trade_date), float(row.open), float(row.high), float(row.low), float(row.close), row.volume) == ("2024-01-02", 10, 12, 9, 11, 5)
    bodies = spark.createDataFrame([("A", text)], "symbol string, body string")
    found = price_csv.parse_named_payloads(bodies).collect()
    if len({line for line in text.splitlines() if "open" in line}) < 2:
        assert [r.header_ok for r in found] == [reasons[0] != ["bad_header"]] * len(found)
        assert sum(r._bad is not None for r in found if r.header_ok) == sum(r == ["unparsable"] for r in reasons)


def test_daily_job_by_name(spark, make_bars, tmp_path):
    bars = many_bars(make_bars)
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    for i, columns in enumerate(ORDERS):
        dated = history.merge(bars, bars.limit(0)).where(F.pmod(F.ascii("symbol"), F.lit(3)) == i).withColumn("fetch_date", F.lit(day(i)))
        price_csv.write_prices(dated, files, columns)
        daily_ingest.run_daily(spark, files, store, day(i), by_name=True)
    got = daily_ingest.read_history(spark, store).select("symbol", "trade_date", *BAR_VALUES).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, bars.select("symbol", "trade_date", *BAR_VALUES).collect()))
    assert {r.status for r in daily_ingest.read_runs(spark, store).collect()} == {"ok"}


# one writer, and old versions


def _run(spark, make_bars, files, store, n, close):
    bars = make_bars([("A", "2024-03-01", 100, 150, 90, close, 1)]).withColumn("fetch_date", F.lit(day(n)))
    price_csv.write_prices(bars, files)
    daily_ingest.run_daily(spark, files, store, day(n))


def test_a_second_writer_is_refused(spark, make_bars, tmp_path):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    _run(spark, make_bars, files, store, 1, 110)
    assert not (tmp_path / "store" / "writer.lock").exists()
    with daily_ingest.only_writer(spark, store):
        with pytest.raises(RuntimeError):
            _run(spark, make_bars, files, store, 2, 120)
    runs = daily_ingest.read_runs(spark, store).orderBy("run_date").collect()
    assert [r.status for r in runs] == ["ok", "failed"] and "another writer" in runs[1].reason
    daily_ingest.run_daily(spark, files, store, day(3))  # takes in what the refused run left
    assert daily_ingest.read_history(spark, store).first().close_c == 120
    (tmp_path / "store" / "writer.lock").write_text("")  # of a run that was killed
    with pytest.raises(RuntimeError):
        daily_ingest.run_daily(spark, files, store, day(4))
    with daily_ingest.only_writer(spark, store, stale=datetime.timedelta(0)):
        pass
    daily_ingest.run_daily(spark, files, store, day(4))


def test_vacuum_spares_versions_a_reader_may_hold(spark, make_bars, tmp_path):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    assert daily_ingest.vacuum(spark, store) == 0
    for n in (1, 2, 3):
        _run(spark, make_bars, files, store, n, 110 + n)
    held = daily_ingest.read_history(spark, store)
    versions = tmp_path / "store" / "current"
    before = sorted(p.name for p in versions.glob("version=*/period=*/.."))
    assert daily_ingest.vacuum(spark, store, datetime.timedelta(hours=1)) == 0
    assert daily_ingest.vacuum(spark, store, datetime.timedelta(0)) == 2
    assert len(before) == 3 and len(list(versions.glob("version=*/period=*"))) == 1
    assert held.first().close_c == daily_ingest.read_history(spark, store).first().close_c == 113
    assert daily_ingest.vacuum(spark, store, datetime.timedelta(0)) == 0
