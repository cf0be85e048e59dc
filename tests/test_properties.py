"""What must hold for any input: order, partitioning and repetition do not matter."""

import datetime
import random
import re

import pytest
from conftest import by_key
from pyspark.sql import functions as F
from test_plans import plan_of

from barloom.operators import bars as bar_ops
from barloom.operators import charts, forecast, history, indicators, quality
from barloom.sources import landing, price_csv
from barloom.sources.tables import order_bars, order_ticks
from barloom.streaming import daily_ingest, tick_bars

SF = "/root/testdata/sf0.001"
START = datetime.date(2024, 1, 1)


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def bars(spark):
    cached = order_bars(spark, SF).cache()
    yield cached
    cached.unpersist()  # or plans tested later would show the cache


@pytest.fixture
def random_bars(make_bars):
    def build(seed, symbols=3, days=40):
        rng = random.Random(seed)
        rows = []
        for s in range(symbols):
            for d in sorted(rng.sample(range(days * 2), days)):
                c = rng.randint(100, 5000)
                rows.append((f"S{s}", str(START + datetime.timedelta(d)), c, c + 5, c - 5, c, rng.randint(1, 9)))
        return make_bars(rows)

    return build


OPERATORS = {
    "daily_return": indicators.daily_return,
    "moving_average": lambda b: indicators.moving_average(b, 5, 20),
    "rolling_volatility": indicators.rolling_volatility,
    "summary_stats": indicators.summary_stats,
    "drawdown": indicators.drawdown,
    "calendar_fill": indicators.calendar_fill,
    "top_movers": indicators.top_movers,
    "volume_stats": indicators.volume_stats,
    "weekday_effect": indicators.weekday_effect,
    "month_effect": indicators.month_effect,
    "weekly": lambda b: bar_ops.resample(b, "week"),
    "chart_line": charts.chart_line,
    "chart_box": lambda b: charts.chart_box(b, "close_c"),
    "features": forecast.features,
    "walk_forward": forecast.walk_forward,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_partitioning_does_not_matter(bars, name):
    """Equal to the last bit, except where an operator rounds floating sums."""
    operator = OPERATORS[name]
    assert rows_of(operator(bars)) == rows_of(operator(bars.orderBy(F.rand(3)).repartition(13)))


def test_tick_order_does_not_matter(spark):
    ticks = order_ticks(spark, SF)
    assert rows_of(bar_ops.daily_bars(ticks)) == rows_of(
        bar_ops.daily_bars(ticks.orderBy(F.desc("seq")).repartition(11))
    )


def test_merging_twice_changes_nothing(random_bars):
    old, new = random_bars(1), random_bars(2)
    once = history.merge(old, new)
    assert rows_of(history.merge(once, new)) == rows_of(once)
    assert rows_of(history.merge(new, new)) == rows_of(new)


def test_merge_against_dict(random_bars):
    old, new = random_bars(3), random_bars(4)
    want = {**by_key(old, "close_c", "symbol", "trade_date"), **by_key(new, "close_c", "symbol", "trade_date")}
    assert by_key(history.merge(old, new), "close_c", "symbol", "trade_date") == want


def test_diff_against_dicts(random_bars):
    old, new = random_bars(5), random_bars(6).unionByName(random_bars(5).where("symbol = 'S1'"))
    new = history.latest(new.withColumn("v", F.lit(1)), "v")
    keys = ("symbol", "trade_date")
    a, b = ({r[:2]: tuple(r)[2:] for r in map(tuple, df.collect())} for df in (old, new))
    want = {
        k: "added" if k not in a else "dropped" if k not in b else "same" if a[k] == b[k] else "revised"
        for k in {*a, *b}
    }
    assert {"added", "dropped", "same"} <= set(want.values())
    assert by_key(history.snapshot_diff(old, new), "status", *keys) == want


def test_correlation_is_the_same_for_any_blocking(random_bars):
    bars = random_bars(8, symbols=9)
    want = rows_of(charts.chart_correlation(bars, symbols_per_block=64))
    assert len(want) == 36
    for size in [1, 2, 4]:
        assert rows_of(charts.chart_correlation(bars, symbols_per_block=size)) == want
    chosen = bars.select("symbol").distinct().orderBy("symbol").limit(3)
    some = rows_of(charts.chart_correlation(bars, chosen=chosen.union(chosen)))
    names = [r.symbol for r in chosen.collect()]
    among = charts.chart_correlation(bars).where(F.col("symbol_a").isin(names) & F.col("symbol_b").isin(names))
    assert len(some) == 3 and some == rows_of(among)


def test_correlation_is_the_same_for_any_tiling(random_bars, monkeypatch):
    bars = random_bars(8, symbols=9)
    want = rows_of(charts.chart_correlation(bars))
    for cells in [1, 150]:
        monkeypatch.setattr(charts, "CELLS_PER_TILE", cells)
        for size in [4, 64]:
            assert rows_of(charts.chart_correlation(bars, symbols_per_block=size)) == want


def test_copies_of_a_series_do_not_grow_with_the_symbols(spark):
    def copies(symbols):
        key = F.col("id") % symbols
        day, close = F.date_add(F.lit(START), F.floor(F.col("id") / symbols).cast("int")), 100 + F.pmod(F.xxhash64("id"), F.lit(50))
        bars = spark.range(3 * symbols).select(key.cast("string").alias("symbol"), day.alias("trade_date"), close.alias("close_c"))
        pairs = charts.chart_correlation(bars, min_days=2)
        assert pairs.count() == symbols * (symbols - 1) // 2
        (blocks,) = re.findall(r"pmod\(xxhash64\(symbol#\d+, 42\), (\d+)\)", plan_of(pairs))
        return int(blocks)

    assert copies(600) == copies(1_200) == 8


def test_pairs_of_few_shared_days_have_n_and_no_correlation(make_bars):
    days = {"A": range(2, 8), "B": range(2, 8), "C": range(6, 12), "D": range(20, 24)}
    rows = [(s, f"2024-01-{d:02d}", c, c, c, c, 1) for s in days for d in days[s] for c in [100 + d * d % 7 + ord(s)]]
    got = charts.chart_correlation(make_bars(rows)).collect()
    assert sorted((r.symbol_a, r.symbol_b, r.n, r.correlation is None) for r in got) == [
        ("A", "B", 5, False), ("A", "C", 1, True), ("B", "C", 1, True)
    ]


def test_bars_without_a_symbol_are_in_no_pair(make_bars):
    rows = [(s, f"2024-01-{d:02d}", c, c, c, c, 1) for s in ["B", None, "A"] for d in range(1, 9) for c in [100 + d * d % 7 + len(s or "")]]
    got = charts.chart_correlation(make_bars(rows).orderBy("trade_date")).collect()
    assert [(r.symbol_a, r.symbol_b, r.n) for r in got] == [("A", "B", 7)]


def test_correlation_of_a_flat_series_is_null(make_bars):
    rows = [("A", f"2024-01-{d:02d}", 1, 1, 1, 100, 1) for d in range(1, 8)]
    rows += [("B", f"2024-01-{d:02d}", 1, 1, 1, 100 + d * d, 1) for d in range(1, 8)]
    row = charts.chart_correlation(make_bars(rows)).first()
    assert (row.n, row.correlation) == (6, None)


@pytest.mark.parametrize("seed", [11, 12])
def test_walk_forward_does_not_see_later_prices(random_bars, seed):
    bars = random_bars(seed)
    day = START + datetime.timedelta(45)
    altered = bars.withColumn(
        "close_c", F.when(F.col("trade_date") > F.lit(day), F.col("close_c") * 7 + 1).otherwise(F.col("close_c"))
    )
    known = F.col("trade_date") <= F.lit(day)
    shown = ["symbol", "trade_date", "n", "slope", "prediction"]
    a = forecast.walk_forward(bars, 5).where(known).select(*shown)
    b = forecast.walk_forward(altered, 5).where(known).select(*shown)
    assert a.where("slope is not null").count() > 0
    assert rows_of(a) == rows_of(b)


def test_walk_forward_equals_a_fit_per_day(random_bars):
    import numpy as np

    bars = random_bars(13, symbols=1)
    closes = [r.close_c / 100 for r in bars.orderBy("trade_date").collect()]
    rows = forecast.walk_forward(bars, min_pairs=5).orderBy("trade_date").collect()
    for t, row in enumerate(rows):
        if t < 5:
            assert row.prediction is None
        else:
            slope, intercept = np.polyfit(closes[:t], closes[1 : t + 1], 1)
            assert row.slope == pytest.approx(slope)
            assert row.prediction == pytest.approx(intercept + slope * closes[t])


def test_features_do_not_see_later_prices(random_bars):
    bars = random_bars(14)
    day = START + datetime.timedelta(40)
    altered = bars.withColumn(
        "close_c", F.when(F.col("trade_date") > F.lit(day), 1).otherwise(F.col("close_c"))
    )
    known = F.col("trade_date") <= F.lit(day)
    shown = ["symbol", "trade_date", "x1", "x2", "x_lag2", "x_mean5"]
    assert rows_of(forecast.features(bars).where(known).select(*shown)) == rows_of(
        forecast.features(altered).where(known).select(*shown)
    )


def test_landing_again_changes_nothing(spark, random_bars, tmp_path):
    path = str(tmp_path / "landed")
    first, second = random_bars(20), random_bars(21).where("symbol = 'S1'")
    landing.land(first, path)
    landing.land(second, path)
    once = rows_of(landing.read_landed(spark, path))
    landing.land(second, path)
    assert rows_of(landing.read_landed(spark, path)) == once
    assert once == rows_of(first.where("symbol <> 'S1'").unionByName(second))


def test_symbols_that_look_like_numbers_stay_text(spark, make_bars, tmp_path):
    bars = make_bars([("007", "2024-01-02", 1, 1, 1, 1, 1), ("A/B C", "2024-01-02", 1, 1, 1, 1, 1)])
    landing.land(bars, str(tmp_path / "landed"))
    assert rows_of(landing.read_landed(spark, str(tmp_path / "landed"))) == rows_of(bars)
    price_csv.write_prices(bars.withColumn("fetch_date", F.lit(START)), str(tmp_path / "csv"))
    assert {r.symbol for r in price_csv.read_prices(spark, str(tmp_path / "csv")).collect()} == {"007", "A/B C"}


def write_days(bars, path, fetch_date):
    price_csv.write_prices(bars.withColumn("fetch_date", F.lit(fetch_date)), path)


@pytest.mark.parametrize("max_files", [None, 1])
def test_any_split_into_files_gives_the_same_history(spark, random_bars, tmp_path, max_files):
    bars = random_bars(30)
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    write_days(bars.where(F.dayofmonth("trade_date") <= 9), files, START)
    write_days(bars.where(F.dayofmonth("trade_date") > 9), files, START)
    daily_ingest.run_daily(spark, files, store, START, max_files)
    assert rows_of(daily_ingest.read_history(spark, store)) == rows_of(bars)
    run = daily_ingest.read_runs(spark, store).first()
    assert (run.status, run.rows_in, run.rows_ok, run.rows_rejected) == ("ok", 120, 120, 0)


def test_newest_fetch_wins_whatever_the_batch(spark, random_bars, tmp_path):
    """An older fetch that arrives late does not overwrite a newer one."""
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    newer, older = random_bars(31, symbols=1), random_bars(32, symbols=1)
    write_days(newer, files, START + datetime.timedelta(1))
    daily_ingest.run_daily(spark, files, store, START, period="month")
    write_days(older, files, START)
    daily_ingest.run_daily(spark, files, store, START, period="month")
    assert rows_of(daily_ingest.read_history(spark, store)) == rows_of(history.merge(older, newer))


def test_file_rewritten_under_its_name_is_not_seen(spark, make_bars, tmp_path):
    """Why landed names must be new for each fetch."""
    files, store = tmp_path / "files", str(tmp_path / "store")
    write_days(make_bars([("A", "2024-01-02", 10, 12, 9, 11, 1)]), str(files), START)
    daily_ingest.run_daily(spark, str(files), store, START)
    (landed,) = files.rglob("*.csv")
    landed.with_name(f".{landed.name}.crc").unlink()
    landed.write_text("trade_date,open,high,low,close,volume\n2024-01-02,9,9,9,9,9\n")
    assert daily_ingest.ingest_new_files(spark, str(files), store) == []
    renamed = landed.with_name("again.csv")
    renamed.write_text("trade_date,open,high,low,close,volume\n2024-01-03,9,9,9,9,9\n")
    assert daily_ingest.ingest_new_files(spark, str(files), store) == [1]
    assert daily_ingest.read_history(spark, store).count() == 2


def test_runs_are_logged(spark, make_bars, tmp_path):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    good = ("A", "2024-01-02", 10, 12, 9, 11, 1)
    write_days(make_bars([good, ("A", "2024-01-03", 10, 9, 12, 11, 1)]), files, START)
    daily_ingest.run_daily(spark, files, store, datetime.date(2024, 1, 4))
    daily_ingest.run_daily(spark, files, store, datetime.date(2024, 1, 5))
    write_days(make_bars([("B", "2024-01-03", 10, 9, 12, 11, 1)]), files, START)
    daily_ingest.run_daily(spark, files, store, datetime.date(2024, 1, 6))
    got = [tuple(r)[1:] for r in daily_ingest.read_runs(spark, store).orderBy("run_date").collect()]
    assert got == [
        (datetime.date(2024, 1, 4), "ok", "some rows rejected", 2, 1, 1),
        (datetime.date(2024, 1, 5), "empty", "no rows delivered", 0, 0, 0),
        (datetime.date(2024, 1, 6), "failed", "no acceptable row", 1, 0, 1),
    ]
    rejected = daily_ingest.read_rows(spark, store).where("not is_ok").collect()
    assert sorted(r.symbol for r in rejected) == ["A", "B"]


def test_ingest_with_another_header(spark, tmp_path):
    folder = tmp_path / "files" / "fetch_date=2024-01-05" / "symbol=A"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("day,o,h,l,c,v\n2024-01-02,1,1,1,1,1\n")
    store = str(tmp_path / "store")
    daily_ingest.run_daily(spark, str(tmp_path / "files"), store, START, header="day,o,h,l,c,v")
    assert daily_ingest.read_history(spark, store).count() == 1


def test_a_batch_remakes_only_its_own_periods(spark, make_bars, tmp_path):
    files, store = str(tmp_path / "files"), tmp_path / "store"
    days = ["2022-12-31", "2023-01-01", "2023-12-31", "2024-01-01"]
    first = make_bars([("A", day, 10, 12, 9, 11, 1) for day in days])
    write_days(first, files, START)
    daily_ingest.run_daily(spark, files, str(store), START)
    def held():
        return {str(p.relative_to(store / "current")): p.stat().st_mtime_ns for p in (store / "current").rglob("*.parquet")}

    before = held()
    assert {name.split("/")[1] for name in before} == {f"period={year}-01-01" for year in (2022, 2023, 2024)}

    second = make_bars([("A", day, 20, 22, 19, 21, 1) for day in [days[0], days[3]]])
    write_days(second, files, START + datetime.timedelta(1))
    daily_ingest.run_daily(spark, files, str(store), START)
    after = held()
    assert {name: after[name] for name in before} == before  # readers of the old version are not disturbed
    made = {"/".join(name.split("/")[:2]) for name in after.keys() - before.keys()}
    assert made == {"version=1/period=2022-01-01", "version=1/period=2024-01-01"}
    assert rows_of(daily_ingest.read_history(spark, str(store))) == rows_of(history.merge(first, second))


def test_file_without_header_is_rejected(spark, make_bars, tmp_path):
    files, store = tmp_path / "files", str(tmp_path / "store")
    write_days(make_bars([("A", "2024-01-02", 10, 12, 9, 11, 1)]), str(files), START)
    (files / "fetch_date=2024-01-01" / "symbol=A" / "swapped.csv").write_text(
        "trade_date,close,high,low,open,volume\n2024-01-03,1,1,1,1,1\n"
    )
    daily_ingest.run_daily(spark, str(files), store, START)
    assert [str(r.trade_date) for r in daily_ingest.read_history(spark, store).collect()] == ["2024-01-02"]
    reasons = [r.reasons for r in daily_ingest.read_rows(spark, store).where("not is_ok").collect()]
    assert reasons == [["bad_header"], ["bad_header"]]


def test_missing_setting(spark, tmp_path):
    with pytest.raises(ValueError, match="landing"):
        daily_ingest.run_daily(spark, "", str(tmp_path), START)


def test_failing_run_is_logged_and_raised(spark, make_bars, tmp_path, monkeypatch):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    write_days(make_bars([("A", "2024-01-02", 10, 12, 9, 11, 1)]), files, START)

    def broken(*args, **kwargs):
        raise RuntimeError("no space left")

    monkeypatch.setattr(daily_ingest, "classify", broken)
    with pytest.raises(Exception):
        daily_ingest.run_daily(spark, files, store, START)
    row = daily_ingest.read_runs(spark, store).first()
    assert row.status == "failed" and "no space left" in row.reason
    monkeypatch.undo()
    daily_ingest.run_daily(spark, files, store, START)
    assert daily_ingest.read_history(spark, store).count() == 1


def test_submitted_job(spark, make_bars, tmp_path, capsys):
    import json

    import daily

    files, store = str(tmp_path / "files"), str(tmp_path / "store")

    def submit():
        code = daily.main(["--landing", files, "--store", store, "--run-date", "2024-01-04"])
        return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])["status"]

    write_days(make_bars([("A", "2024-01-02", 10, 12, 9, 11, 1)]), files, START)
    assert submit() == (0, "ok")
    assert submit() == (0, "empty")
    write_days(make_bars([("A", "2024-01-03", 10, 9, 12, 11, 1)]), files, START)
    assert submit() == (1, "failed")
    with pytest.raises(SystemExit):
        daily.main(["--landing", files])


def test_refresh_that_broke_off_is_done_by_the_next_run(spark, random_bars, tmp_path, monkeypatch):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    first, second = random_bars(40), random_bars(41)
    write_days(first, files, START)
    daily_ingest.run_daily(spark, files, store, START)

    write_days(second, files, START + datetime.timedelta(1))
    with monkeypatch.context() as patch:
        patch.setattr(daily_ingest, "to_bars", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            daily_ingest.run_daily(spark, files, store, START)
    assert rows_of(daily_ingest.read_history(spark, store)) == rows_of(first)
    daily_ingest.run_daily(spark, files, store, START)
    assert rows_of(daily_ingest.read_history(spark, store)) == rows_of(history.merge(first, second))


def test_empty_store(spark, tmp_path):
    assert daily_ingest.read_history(spark, str(tmp_path / "none")).count() == 0
    assert daily_ingest.read_rows(spark, str(tmp_path / "none")).count() == 0


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def test_streamed_bars_over_several_files(spark, tmp_path):
    """Ticks of one day spread over batches; a tick far behind the watermark is dropped."""
    folder, store = str(tmp_path / "events"), str(tmp_path / "store")

    def arrive(*ticks):
        rows = [(i, datetime.datetime.fromisoformat(ts), 1, "A", v, "") for i, ts, v in ticks]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)
        stream = tick_bars.stream_daily_bars(tick_bars.event_stream(spark, folder), "1 day")
        tick_bars.store_bars(stream, store)

    arrive((2, "2024-01-01 10:00:00", 2.0), (3, "2024-01-01 23:59:59", 1.0))
    arrive((1, "2024-01-01 09:00:00", 3.0), (4, "2024-01-02 00:00:00", 9.0))
    arrive((5, "2024-01-06 00:00:00", 4.0))
    arrive((6, "2024-01-01 12:00:00", 99.0), (7, "2024-01-05 12:00:00", 5.0))
    got = {str(r.trade_date): tuple(r)[2:] for r in tick_bars.read_bars(spark, store).collect()}
    assert got == {
        "2024-01-01": (300, 300, 100, 100, 3),
        "2024-01-02": (900, 900, 900, 900, 1),
        "2024-01-05": (500, 500, 500, 500, 1),
        "2024-01-06": (400, 400, 400, 400, 1),
    }


def test_wide_key_sorts_by_high_then_low(spark):
    from barloom.functions.columns import wide_key

    top = 2**63 - 1
    pairs = [(a, b) for a in (0, 1, 9, 10**18, top) for b in (0, 1, 10**18, top)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint").repartition(3)
    got = df.orderBy(wide_key(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == sorted(pairs)


@pytest.mark.parametrize("rows", [1, 2, 7, 60])
def test_rolling_measures_against_lists(random_bars, rows):
    import statistics

    bars = random_bars(50, symbols=2)
    both = indicators.volume_stats(
        indicators.rolling_volatility(indicators.moving_average(bars, rows), rows), rows
    )
    for symbol in ["S0", "S1"]:
        got = both.where(F.col("symbol") == symbol).orderBy("trade_date").collect()
        for t, row in enumerate(got):
            part = got[max(0, t - rows + 1) : t + 1]
            closes = [r.close_c / 100 for r in part]
            assert row[f"sma_{rows}"] == pytest.approx(statistics.mean(closes))
            if len(closes) > 1:
                assert row[f"sd_{rows}"] == pytest.approx(statistics.stdev(closes), abs=1e-9)
            else:
                assert row[f"sd_{rows}"] is None
            assert row.mean_volume == pytest.approx(statistics.mean(r.volume for r in part))


def test_streamed_bars_in_append_mode_wait_for_the_watermark(spark, tmp_path):
    """A day is emitted once, when no tick that is not too late can change it any more."""
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")

    def arrive(*ticks):
        rows = [(i, datetime.datetime.fromisoformat(ts), 1, "A", v, "") for i, ts, v in ticks]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)
        stream = tick_bars.stream_daily_bars(tick_bars.event_stream(spark, folder), "1 day")
        (
            stream.writeStream.outputMode("append")
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start(out)
            .awaitTermination()
        )
        return sorted((str(r.trade_date), r.close_c, r.volume) for r in spark.read.parquet(out).collect())

    assert arrive((1, "2024-01-01 10:00:00", 1.0), (2, "2024-01-02 10:00:00", 2.0)) == []
    assert arrive((3, "2024-01-03 12:00:00", 3.0), (4, "2024-01-01 11:00:00", 4.0)) == [("2024-01-01", 400, 2)]
    assert arrive((5, "2024-01-09 12:00:00", 5.0)) == [
        ("2024-01-01", 400, 2), ("2024-01-02", 200, 1), ("2024-01-03", 300, 1),
    ]


@pytest.mark.parametrize("max_files", [None, 1, 2])
def test_partial_bars_do_not_depend_on_batches(spark, tmp_path, max_files):
    """Days far apart, newest first, and one day spread over all files: no tick is lost."""
    folder, store = tmp_path / "events.parquet", str(tmp_path / "store")
    for k, day in enumerate([28, 1, 14]):
        rows = [
            (10 * i + k, datetime.datetime(2024, 1, day if i % 2 else 3, 12, i), 1, "A", float(i + k), "")
            for i in range(20)
        ]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(folder))
    stream = tick_bars.event_stream(spark, f"{tmp_path}/events.parque[t]", max_files=max_files)
    tick_bars.store_partial_bars(stream, store)
    got = {r.trade_date.day: tuple(r)[2:] for r in tick_bars.combine_bars(spark, store).collect()}
    assert got[3] == (0, 2000, 0, 2000, 30)
    assert sum(bar[-1] for bar in got.values()) == 60 and sorted(got) == [1, 3, 14, 28]


@pytest.mark.parametrize("max_files", [None, 1, 2])
def test_repeats_within_a_fetch_follow_the_file_name(spark, tmp_path, max_files):
    folder, store = tmp_path / "landing", str(tmp_path / "store")
    for name, close in [("c", 12), ("a", 10), ("b", 11)]:
        path = folder / "fetch_date=2024-01-03" / "symbol=A" / f"{name}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"trade_date,open,high,low,close,volume\n2024-01-02,10,20,5,{close},1\n")
    daily_ingest.run_daily(spark, str(folder), store, START, max_files)
    assert [r.close_c for r in daily_ingest.read_history(spark, store).collect()] == [1000]
    with pytest.raises(ValueError, match="kept by year"):
        daily_ingest.run_daily(spark, str(folder), store, START, period="month")
    assert [r.status for r in daily_ingest.read_runs(spark, store).collect()].count("failed") == 1


def test_a_refresh_that_breaks_keeps_the_counts(spark, random_bars, tmp_path, monkeypatch):
    files, store = str(tmp_path / "landing"), str(tmp_path / "store")
    bars = random_bars(15, symbols=1)
    n = bars.count()
    price_csv.write_prices(bars.withColumn("fetch_date", F.lit(START)), files)

    def broken(*_):
        raise RuntimeError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(daily_ingest, "refresh_history", broken)
        with pytest.raises(RuntimeError):
            daily_ingest.run_daily(spark, files, store, START)
    daily_ingest.run_daily(spark, files, store, START)
    runs = {r.status: r.rows_ok for r in daily_ingest.read_runs(spark, store).collect()}
    assert runs == {"failed": n, "empty": 0}
    assert daily_ingest.read_history(spark, store).count() == n


def test_unsound_prices_and_volumes_are_rejected(spark, tmp_path):
    path = tmp_path / "fetch_date=2024-01-03" / "symbol=A" / "f.csv"
    path.parent.mkdir(parents=True)
    lines = ["trade_date,open,high,low,close,volume", "2024-01-02,10,20,5,11,", "2024-01-03,-2,-2,-2,-2,1", "2024-01-04,0.1234,0.1299,0.1201,0.1249,1"]
    path.write_text("\n".join(lines) + "\n")
    checked = quality.classify(price_csv.read_checked(spark, str(tmp_path)), ["source_file"], ["fetch_date"])
    got = {r.trade_date.day: r.reasons for r in checked.collect()}
    assert got == {2: ["null_volume"], 3: ["non_positive_price"], 4: ["sub_cent"]}
    with pytest.raises(ValueError, match="by position"):
        price_csv.read_checked(spark, str(tmp_path), "timestamp,close,high,low,open,volume")


def test_a_halted_symbol_has_no_correlation(spark, make_bars):
    """Its return is the same on all shared days, though not on its others."""
    days = [f"2024-01-{d:02d}" for d in range(1, 21)]
    halted = [10_000, 10_100, 10_203] + [10_203] * 17
    moving = [(d, 10_000 + (i * i * 37) % 311) for i, d in enumerate(days)]
    rows = [("H", d, c, c, c, c, 1) for d, c in zip(days, halted)] + [("M", d, c, c, c, c, 1) for d, c in moving[4:]]
    got = charts.chart_correlation(make_bars(rows)).collect()
    assert [(r.symbol_a, r.symbol_b, r.correlation) for r in got] == [("H", "M", None)]


def test_a_young_symbol_gets_a_row_without_a_prediction(spark, make_bars):
    rows = [("A", f"2024-01-{d:02d}", 100 + d * d % 7, 200, 50, 100 + d * d % 7, 1) for d in range(1, 21)]
    rows.append(("B", "2024-01-20", 100, 200, 50, 100, 1))
    split = forecast.chrono_split(forecast.features(make_bars(rows)), datetime.date(2024, 1, 15))
    model = forecast.fit_ols(forecast.train_rows(split))
    got = {r.symbol: r.prediction for r in forecast.predict_close(model, split).where("split = 'forecast'").collect()}
    assert set(got) == {"A", "B"} and got["B"] is None and got["A"] is not None


def body_of(*lines):
    return "\n".join(["trade_date,open,high,low,close,volume", *lines])


def test_bodies_reach_the_history_and_are_kept(spark, tmp_path):
    store = str(tmp_path / "store")

    def run(rows, columns="symbol string, fetch_date date, status int, body string"):
        return daily_ingest.run_payloads(spark, spark.createDataFrame(rows, columns), store, START)

    later = START + datetime.timedelta(1)
    given = [
        ("A", START, 200, body_of("2024-01-02,10,20,5,11,1", "2023-01-02,10,20,5,12,1")),
        ("B", START, None, body_of("2024-01-02,10,20,5,13,1")),
        ("C", START, 503, body_of("2024-01-02,10,20,5,14,1")),
        ("D", START, 200, '{"message": "limit reached"}'),
        ("E", START, 404, None),
    ]
    run(given)
    assert sorted(map(tuple, daily_ingest.read_bodies(spark, store).collect())) == sorted(given)
    rejected = daily_ingest.read_rows(spark, store).where("not is_ok").collect()
    assert {r.symbol: r.reasons for r in rejected} == {"C": ["http_status"], "D": ["bad_header"], "E": ["http_status"]}
    run([("A", later, body_of("2024-01-02,10,20,5,15,1"))], "symbol string, fetch_date date, body string")
    run([("A", None, 200, body_of("2024-01-02,10,20,5,16,1"))])  # an unknown fetch counts as the oldest
    run([])
    got = {(r.symbol, r.trade_date.year): r.close_c for r in daily_ingest.read_history(spark, store).collect()}
    assert got == {("A", 2024): 1500, ("A", 2023): 1200, ("B", 2024): 1300}
    statuses = sorted((r.status, r.rows_in) for r in daily_ingest.read_runs(spark, store).collect())
    assert statuses == [("empty", 0), ("ok", 1), ("ok", 1), ("ok", 6)]
    with pytest.raises(ValueError, match="from bodies"):
        daily_ingest.run_daily(spark, str(tmp_path), store, START)


def test_a_refresh_reads_no_older_batch(spark, make_bars, tmp_path):
    """The rows of older batches may even be gone."""
    files, store = str(tmp_path / "files"), tmp_path / "store"
    first = make_bars([("A", "2024-01-02", 10, 12, 9, 11, 1), ("A", "2024-01-03", 10, 12, 9, 11, 1)])
    second = make_bars([("A", "2024-01-03", 20, 22, 19, 21, 1)])
    write_days(first, files, START)
    daily_ingest.run_daily(spark, files, str(store), START)
    for part in (store / "rows" / "batch_id=0").rglob("*.parquet"):
        part.write_bytes(b"")
        part.with_name(f".{part.name}.crc").unlink()
    write_days(second, files, START + datetime.timedelta(1))
    daily_ingest.run_daily(spark, files, str(store), START)
    assert rows_of(daily_ingest.read_history(spark, str(store))) == rows_of(history.merge(first, second))


def test_a_missing_run_date_is_logged(spark, tmp_path):
    with pytest.raises(ValueError, match="run_date"):
        daily_ingest.run_daily(spark, str(tmp_path), str(tmp_path / "store"), None)
    row = daily_ingest.read_runs(spark, str(tmp_path / "store")).first()
    assert (row.run_date, row.status, row.reason) == (None, "failed", "required setting run_date is missing")
