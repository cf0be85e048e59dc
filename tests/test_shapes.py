"""Patterns, sketches and densities against plain Python."""

import datetime
import math
import random
import re

import pytest
from conftest import by_key
from pyspark.sql import functions as F

from barloom.operators import charts, indicators, patterns, sketches


def _random_bars(make_bars, n, symbols="AB", seed=71):
    random.seed(seed)
    rows = []
    for s in symbols:
        close = 1_000
        for i in range(n):
            close += random.choice([-2, -1, -1, 0, 1, 1, 3])
            day = datetime.date(2020, 1, 1) + datetime.timedelta(days=i)
            rows.append((s, str(day), close, close + random.randrange(5), close - random.randrange(5), close, random.randrange(1, 50)))
    return make_bars(rows)


def _closes(bars):
    found = {}
    for r in bars.orderBy("symbol", "trade_date").collect():
        found.setdefault(r.symbol, []).append((r.trade_date, r.close_c))
    return found


@pytest.mark.parametrize("pattern", [patterns.REVERSAL, "U", "F+[UD]F*", "^-", "(?:DU){2}", "X"])
def test_patterns_equal_plain_matches(make_bars, pattern):
    bars = _random_bars(make_bars, 300)
    want = []
    for symbol, own in _closes(bars).items():
        closes = [c for _, c in own]
        word = "-" + "".join("U" if b > a else "D" if b < a else "F" for a, b in zip(closes, closes[1:]))
        for m in re.finditer(pattern, word):
            part = closes[m.start() : m.end()]
            want.append((symbol, m.group(), own[m.start()][0], own[m.end() - 1][0], len(part), part[0], min(part), max(part), part[-1]))
    found = patterns.find(bars, pattern)
    got = [(r.symbol, r.letters, r.start_date, r.end_date, r.n_days, r.first_c, r.low_c, r.high_c, r.last_c) for r in found.collect()]
    assert sorted(got) == sorted(want)


def test_patterns_of_own_letters(make_bars):
    bars = _random_bars(make_bars, 60)
    busy = F.when(F.col("volume") >= 40, "B").otherwise(".")
    got = patterns.find(bars, "B+", busy)
    assert got.agg(F.sum("n_days")).first()[0] == bars.where("volume >= 40").count()
    with pytest.raises(ValueError):
        patterns.find(bars, "U*")
    assert patterns.find(bars.limit(0)).count() == 0


def test_merged_sketches_keep_to_the_rank_error(spark):
    ticks = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 2)).alias("symbol"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("trade_date"),
        F.when(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(50)) != 7, F.pmod(F.xxhash64("id"), F.lit(5_000))).alias("price_c"),
    )
    daily = sketches.daily_sketches(ticks.repartition(5))
    assert daily.where("n_ticks = 0").count() == 0 and daily.agg(F.max(F.length("sketch"))).first()[0] < 10_000
    yearly = sketches.roll_up(sketches.roll_up(daily, "month"), "year")
    found = sketches.quantiles(yearly, 0.05, 0.5, 0.95)
    assert yearly.agg(F.sum("n_ticks")).first()[0] == ticks.where("price_c is not null").count()
    for r in sketches.rank_errors(ticks, found, "year", 0.05, 0.5, 0.95).collect():
        assert max(r.e5, r.e50, r.e95) <= 2 * sketches.RANK_ERROR
    empty = sketches.quantiles(sketches.daily_sketches(ticks.withColumn("price_c", F.lit(None).cast("bigint"))), 0.5)
    assert {r.q50_c for r in empty.limit(5).collect()} == {None}


def test_density_is_that_of_the_values(make_bars):
    bars = _random_bars(make_bars, 500)
    smooth = charts.chart_density(bars, "close_c", points=40, bins=4_000).collect()
    for symbol, own in _closes(bars).items():
        values = [c for _, c in own]
        mean = sum(values) / len(values)
        sd = math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1))
        width = 1.06 * sd * len(values) ** -0.2
        for r in smooth:
            if r.symbol == symbol:
                direct = sum(math.exp(-0.5 * ((r["at"] - v) / width) ** 2) for v in values) / (len(values) * width * math.sqrt(2 * math.pi))
                assert r.density == pytest.approx(direct, rel=0.01, abs=1e-9)
    assert len(smooth) == 80
    same = make_bars([("A", "2024-01-02", 1, 1, 1, 5, 1), ("A", "2024-01-03", 1, 1, 1, 5, 1)])
    assert charts.chart_density(same, "close_c").count() == 0


def test_bins_hold_every_pair_once(make_bars):
    bars = _random_bars(make_bars, 200)
    binned = charts.chart_bins_2d(bars, "close_c", "volume", 8).collect()
    assert sum(r.n for r in binned) == 400
    assert {r.x_bin for r in binned} <= set(range(8)) and {0, 7} <= {r.y_bin for r in binned}


@pytest.mark.parametrize("rows", [65, 100, 250, 251, 10_000])
def test_extremes_by_blocks_equal_those_by_frames(make_bars, rows, monkeypatch):
    bars = _random_bars(make_bars, 250)
    blocks = indicators.rolling_high_low(bars, rows)
    monkeypatch.setattr(indicators, "FRAME", 1 << 30)
    frames = indicators.rolling_high_low(bars, rows)
    for name in ("range_high_c", "range_low_c", "range_position"):
        assert by_key(blocks, name, "symbol", "trade_date") == by_key(frames, name, "symbol", "trade_date")
    assert blocks.columns == frames.columns
