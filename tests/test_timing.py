"""Joins by time, recurrences and sessions against plain Python."""

import datetime
import random
import re

import pytest
from conftest import by_key
from pyspark.sql import functions as F
from test_plans import plan_of

from barloom.operators import joins, recurrences, sessions
from barloom.streaming import tick_sessions

START = datetime.datetime(2024, 1, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


# as-of


def _latest(left, right, strict):
    """{left id: (value, seen)} by looking through all of one key's right rows."""
    held = {}
    for key, when, value, seen in right:
        if key is not None and when is not None:
            held.setdefault(key, []).append((when, value, seen))
    found = {}
    for i, key, when in left:
        best = None
        for other in held.get(key, []) if when is not None else []:
            if other[0] < when or (other[0] == when and not strict):
                best = other if best is None else max(best, other)
        found[i] = (None, None) if best is None else best[1:]
    return found


@pytest.mark.parametrize("strict", [False, True])
def test_asof_equals_brute_force(spark, strict):
    """Ties, nulls in key and time, a key with most rows, slices with no right row, and keys of one side only."""
    random.seed(41)
    keys = ["hot"] * 6 + ["a", "b", "left only", None]
    left = [(i, random.choice(keys), random.choice([None, *map(at, range(0, 20_000, 50))])) for i in range(900)]
    right = [
        (random.choice(["hot", "hot", "a", "b", "right only", None]), random.choice([None, *map(at, range(0, 20_000, 475))]),
         random.randrange(5), random.choice([None, "x", "y"]))
        for _ in range(120)
    ]
    right = [r if r[3] is not None else (*r[:3], "") for r in right]
    a = spark.createDataFrame(left, "id int, symbol string, ts timestamp_ntz").repartition(3)
    b = spark.createDataFrame(right, "symbol string, seen timestamp_ntz, value int, note string").repartition(3)
    for slice_of in (F.to_date, lambda t: F.date_trunc("month", t), lambda t: F.date_trunc("hour", t)):
        got = joins.asof_join(a, b, ["symbol"], "ts", "seen", ["value", "note"], slice_of, strict).collect()
        assert {r.id: (r.value, r.note) for r in got} == _latest(left, right, strict) and len(got) == len(left)


def test_asof_by_several_keys_days_and_numbers(spark):
    left = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 1, 5)], "s string, k int, t int")
    right = spark.createDataFrame([("a", 1, 3, 10), ("a", 1, 6, 11), ("a", 2, 5, 12)], "s string, k int, u int, v int")
    got = joins.asof_join(left, right, ["s", "k"], "t", "u", ["v"], slice_of=lambda t: t)
    assert by_key(got, "v", "s", "k") == {("a", 1): 10, ("a", 2): 12, ("b", 1): None}
    empty = joins.asof_join(left, right.limit(0), ["s", "k"], "t", "u", ["v"], slice_of=lambda t: t)
    assert {r.v for r in empty.collect()} == {None} and empty.count() == 3
    assert joins.asof_join(left.limit(0), right, ["s", "k"], "t", "u", ["v"], slice_of=lambda t: t).count() == 0
    with pytest.raises(ValueError):
        joins.asof_join(left, right.withColumnRenamed("v", "T"), ["s", "k"], "t", "u", ["T"])


def test_asof_splits_a_hot_key(spark):
    """A key with all rows is sorted in a window per day; only a row a day meets by key alone."""
    left = spark.range(2_000).select(F.lit("hot").alias("symbol"), (F.lit(START).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, cast(id * 30 as int))")).alias("ts"))
    right = left.select("symbol", F.col("ts").alias("seen"), F.col("ts").alias("value"))
    joined = joins.asof_join(left, right, ["symbol"], "ts", "seen", ["value"])
    assert joined.where("ts <> value").count() == 0
    plan = plan_of(joined)
    assert "Join" not in plan and "SinglePartition" not in plan
    windows = [line for line in plan.splitlines() if " Window " in line or "Window [" in line]
    assert len(windows) == 2 and sum("slice" in line.split("windowspecdefinition")[1].split("ASC")[0] for line in windows) >= 1


# intervals


@pytest.mark.parametrize("split", [0, 3, 6])
def test_intervals_equal_brute_force(spark, split):
    """Points, short and long intervals, one over everything, repeated ones, and ones that are no interval."""
    random.seed(42)
    day = datetime.date(1970, 3, 1)
    points = [(i, random.choice(["a", "b", None]), random.choice([None, *(day + datetime.timedelta(days=d) for d in range(-200, 400))])) for i in range(300)]
    spans = [(random.choice(["a", "b", "c", None]), random.randrange(-220, 420), random.choice([0, 0, 1, 2, 7, 8, 9, 100, -3])) for _ in range(80)]
    spans = [(k, f"e{i}", day + datetime.timedelta(days=s), day + datetime.timedelta(days=s + n)) for i, (k, s, n) in enumerate(spans)]
    spans += [("a", "all", datetime.date(1900, 1, 1), datetime.date(2100, 1, 1)), ("a", "all", datetime.date(1900, 1, 1), datetime.date(2100, 1, 1))]
    spans += [("a", "none", None, day), ("a", "none", day, None)]
    want = sorted(
        (i, name) for i, key, when in points for other, name, first, last in spans
        if key is not None and key == other and None not in (when, first, last) and first <= when <= last
    )
    a = spark.createDataFrame(points, "id int, symbol string, day date")
    b = spark.createDataFrame(spans, "symbol string, name string, first date, last date")
    got = joins.interval_join(a, b, ["symbol"], "day", "first", "last", split)
    assert sorted((r.id, r.name) for r in got.collect()) == want
    plan = plan_of(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joins.interval_join(a, b.limit(0), ["symbol"], "day", "first", "last").count() == 0


def test_instants_and_numbers_within_intervals(spark):
    spans = spark.createDataFrame([(at(0), at(10)), (at(5), at(5)), (at(-100_000), at(100_000))], "first timestamp_ntz, last timestamp_ntz")
    ticks = spark.createDataFrame([(1, at(0)), (2, at(5)), (3, at(11))], "id int, ts timestamp_ntz")
    got = joins.interval_join(ticks, spans, [], "ts", "first", "last").groupBy("id").count()
    assert by_key(got, "count", "id") == {(1,): 2, (2,): 3, (3,): 1}
    numbers = spark.createDataFrame([(-8, -1), (-1, 2**40)], "first bigint, last bigint")
    found = joins.interval_join(spark.createDataFrame([(-1,), (0,), (-9,)], "n bigint"), numbers, [], "n", "first", "last")
    assert sorted((r.n, r.first) for r in found.collect()) == [(-1, -8), (-1, -1), (0, -1)]
    with pytest.raises(ValueError):
        joins.interval_join(ticks.withColumn("ts", F.lit(1.5)), spans, [], "ts", "first", "last")


def test_a_whole_history_costs_few_rows(spark):
    """An interval is laid in 2^split + 1 bins at most, however long it is."""
    spans = spark.createDataFrame([("a", datetime.date(1000, 1, 1), datetime.date(3000, 1, 1))], "symbol string, first date, last date")
    days = spark.createDataFrame([("a", datetime.date(2000, 1, 1))], "symbol string, day date")
    joined = joins.interval_join(days, spans, ["symbol"], "day", "first", "last")
    assert joined.count() == 1
    length = (datetime.date(3000, 1, 1) - datetime.date(1000, 1, 1)).days
    assert length.bit_length() - 3 > 0 and (length >> (length.bit_length() - 3)) <= 8


def test_few_long_intervals_add_no_copies_of_points(spark):
    """Nor does a row carry a number beside the value it is made from."""
    day = datetime.date(2000, 1, 1)
    spans = [("a", day, day + datetime.timedelta(days=n)) for n in [*range(1, 8)] * 60 + [90, 100]]
    a = spark.createDataFrame([("a", day)], "symbol string, day date")
    b = spark.createDataFrame(spans, "symbol string, first date, last date")
    joined = joins.interval_join(a, b, ["symbol"], "day", "first", "last")
    assert joined.count() == len(spans) and joined.columns == ["symbol", "day", "first", "last"]
    plan = plan_of(joined)
    assert "Generate explode([0])" in plan
    (shuffled,) = re.findall(r"Project \[(symbol#.*point#\d+, class#\d+.*)\]", plan)
    assert shuffled.count(" AS ") == 2


def test_long_intervals_take_the_bins_of_a_lower_class_where_they_are_few():
    highest = lambda held: joins._highest_class(held, 3, 3)
    assert highest({}) == 0 and highest({9: 5}) == 9 and highest({0: 5, 9: 5}) == 9
    assert highest({0: 600, 3: 600, 6: 12, 9: 15}) == 3 and highest({0: 1_000, 6: 1}) == 0
    assert highest({0: 10**9, 48: 1}) == 42  # one interval in 513 bins at most, not in millions


def test_long_intervals_among_many_short_ones_equal_brute_force(spark):
    """Bins shorter than those of the longest class, before and after 0, with a hot key."""
    random.seed(45)
    points = [(i, random.choice(["hot", "hot", "a"]), random.randrange(-3_000, 3_000)) for i in range(400)]
    spans = [(random.choice(["hot", "hot", "a"]), s, s + random.choice([0, 1, 5, 9, 30])) for s in (random.randrange(-3_000, 3_000) for _ in range(300))]
    spans += [("hot", -3_000, 3_000), ("a", -2_999, 1_500), ("a", -64, 63), ("hot", -513, -1)]
    want = sorted((i, *span) for i, key, now in points for span in spans if key == span[0] and span[1] <= now <= span[2])
    a = spark.createDataFrame(points, "id int, symbol string, now bigint")
    b = spark.createDataFrame(spans, "symbol string, first bigint, last bigint")
    got = joins.interval_join(a, b, ["symbol"], "now", "first", "last")
    assert sorted((r.id, r.symbol, r.first, r.last) for r in got.collect()) == want


def test_drawdowns(make_bars):
    closes = [10, 9, 8, 10, 12, 11, 12, 13, 5]
    bars = make_bars([("A", f"2024-01-{i + 1:02d}", c, c, c, c, 1) for i, c in enumerate(closes)])
    rows = sorted((r.start_date.day, r.end_date.day, r.peak_c, r.low_c, r.n_days) for r in joins.under_water(bars).collect())
    assert rows == [(2, 3, 10, 8, 2), (6, 6, 12, 11, 1), (9, 9, 13, 5, 1)]


# recurrences


def _decayed(values, keep):
    state, found = None, []
    for value in values:
        if value is not None:
            state = value if state is None else keep * state + value
        found.append(state)
    return found


@pytest.mark.parametrize("keep", [0.999, 0.94, 0.5, 1e-3, 1e-80])
def test_scans_equal_the_recurrence(spark, keep):
    """Short and long blocks, nulls at their ends too, several symbols."""
    random.seed(43)
    rows, want = [], {}
    for symbol, n in (("a", 1_500), ("b", 700), ("c", 1)):
        values = [None if random.random() < 0.2 else random.uniform(-1, 1) for _ in range(n)]
        days = [datetime.date(2000, 1, 1) + datetime.timedelta(days=i) for i in range(n)]
        rows += [(symbol, d, v) for d, v in zip(days, values)]
        want |= {(symbol, d): s for d, s in zip(days, _decayed(values, keep))}
    bars = spark.createDataFrame(rows, "symbol string, trade_date date, value double").repartition(5)
    got = by_key(recurrences.decayed(bars, "state", F.col("value"), keep), "state", "symbol", "trade_date")
    assert got.keys() == want.keys()
    for key, state in want.items():
        assert (got[key] is None) == (state is None) and (state is None or got[key] == pytest.approx(state, rel=1e-9, abs=1e-12)), key


def test_scans_need_one_shuffle_and_no_frame(spark, make_bars):
    bars = make_bars([("A", "2024-01-02", 1, 1, 1, 100, 1), ("A", "2024-01-03", 1, 1, 1, 300, 1)])
    measured = recurrences.ew_volatility(recurrences.macd(bars))
    plan = plan_of(measured)
    assert plan.count("Exchange") == 1 and "specifiedwindowframe(RowFrame, -" not in plan.replace("(RowFrame, -1,", "")
    rows = measured.orderBy("trade_date").collect()
    assert [r.ema_12 for r in rows] == pytest.approx([1, 1 + 2 / 13 * 2]) and [r.ew_vol for r in rows] == [None, pytest.approx(2)]
    for keep in (0, 1):
        with pytest.raises(ValueError):
            recurrences.decayed(bars, "s", F.col("close_c"), keep)


# sessions

GAP = datetime.timedelta(minutes=30)
TICKS = "symbol string, ts timestamp_ntz, price_c bigint, seq bigint"


def _ticks(n):
    random.seed(44)
    found = []
    for i in range(n):
        found.append((random.choice(["hot", "hot", "hot", "a", "b"]), at(random.choice([random.randrange(30_000), random.randrange(60) * 30])), random.randrange(100, 200), i))
    return found


def _sessions(ticks):
    found, held = [], {}
    for symbol, when, price, seq in ticks:
        if symbol is not None and when is not None:
            held.setdefault(symbol, []).append((when, seq, price))
    for symbol, own in held.items():
        own.sort()
        run = []
        for tick in [*own, None]:
            if run and (tick is None or tick[0] - run[-1][0] > GAP):
                prices = [p for *_, p in run]
                ends = [round((t - datetime.datetime(1970, 1, 1)) / datetime.timedelta(microseconds=1)) for t in (run[0][0], run[-1][0])]
                found.append((symbol, *ends, prices[0], max(prices), min(prices), prices[-1], len(run)))
                run = []
            run.append(tick)
    return sorted(found)


def test_sessions_equal_brute_force(spark):
    """Across midnights, with ties, pauses of just the gap, and ticks that belong nowhere."""
    ticks = _ticks(1_500) + [(None, at(0), 1, 1), ("a", None, 1, 2), ("c", at(1_430), 5, 3), ("c", at(1_450), 6, 4), ("c", at(1_480), 7, 5)]
    got = sessions.sessions(spark.createDataFrame(ticks, TICKS).repartition(4), GAP)
    assert sorted(tuple(r) for r in got.collect()) == _sessions(ticks)
    assert sessions.sessions(spark.createDataFrame([], TICKS), GAP).count() == 0
    plan = plan_of(got)
    assert "slice" in plan and "SinglePartition" not in plan


def _stream(spark, folder, parts):
    for i, part in enumerate(parts):
        frame = spark.createDataFrame(part, TICKS).withColumn("ts", F.col("ts").cast("timestamp"))
        frame.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(TICKS.replace("timestamp_ntz", "timestamp")).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_streamed_sessions_take_in_late_ticks(spark, tmp_path):
    ticks = _ticks(400)
    early, late = [t for t in ticks if t[3] % 3], [t for t in ticks if not t[3] % 3]
    store = f"{tmp_path}/store"
    stream = _stream(spark, tmp_path / "in", [sorted(early, key=lambda t: t[1]), late])
    tick_sessions.store_sessions(stream, store, GAP, datetime.timedelta(days=2))
    assert sorted(tuple(r) for r in tick_sessions.read_sessions(spark, store, GAP).collect()) == _sessions(ticks)
    # Files may come in either order; what comes second is late if two days behind the newest of the first.
    listed = {r.seq for r in tick_sessions.read_late(spark, store).collect()}
    wanted = []
    for first, second in ((early, late), (late, early)):
        newest = max(t[1] for t in first)
        wanted.append({t[3] for t in second if t[1] < newest - datetime.timedelta(days=2)})
    assert listed in wanted and listed


def test_live_sessions_in_order_equal_those_in_batch(spark, tmp_path):
    ticks = sorted(_ticks(300), key=lambda t: t[1])
    ticks.append(("z", at(90_000), 1, 10_000))  # moves the watermark past all others
    stream = _stream(spark, tmp_path / "in", [ticks]).union(_stream(spark, tmp_path / "more", [[("z", at(90_001), 1, 10_001)]]))
    found = []
    query = (
        tick_sessions.live_sessions(stream, GAP, datetime.timedelta(hours=1))
        .writeStream.foreachBatch(lambda batch, _: found.extend(batch.collect()))
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    columns = ["symbol", "start_us", "end_us", "open_c", "high_c", "low_c", "close_c", "n_ticks"]
    got = sorted(tuple(r[c] for c in columns) for r in found)
    assert got == [s for s in _sessions(ticks) if s[0] != "z"]


def test_the_number_of_parts_is_bounded(spark):
    """A day of one symbol has at most as many parts as the gap fits in, however many ticks it has."""
    ticks = spark.range(20_000).select(
        F.lit("hot").alias("symbol"),
        F.timestamp_millis(F.lit(1_704_067_200_000) + F.pmod(F.xxhash64("id"), F.lit(86_400_000))).alias("ts"),
        F.col("id").alias("price_c"), F.col("id").alias("seq"),
    )
    assert sessions.parts(ticks, GAP).count() <= 48
