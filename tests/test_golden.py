"""One symbol, eight bars over a weekend and a fall after a peak; answers worked by hand."""

import datetime

import pytest
from conftest import values

from barloom.operators import bars as bar_ops
from barloom.operators import charts, forecast, indicators

DAYS = [
    "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05",
    "2024-01-08", "2024-01-09", "2024-01-10", "2024-01-11",
]
CLOSES = [1000, 1100, 1210, 1210, 968, 1000, 1100, 1200]


@pytest.fixture
def bars(make_bars):
    return make_bars(
        [("ABC", day, c, c + 20, c - 30, c, 100) for day, c in zip(DAYS, CLOSES)]
    )


def test_daily_return(bars):
    want = [None, 0.1, 0.1, 0.0, -0.2, 32 / 968, 0.1, 100 / 1100]
    got = values(indicators.daily_return(bars), "ret")
    assert got[0] is None
    assert got[1:] == pytest.approx(want[1:])


def test_log_return(bars):
    got = values(indicators.log_return(bars), "log_ret")
    assert got[:2] == [None, 0.09531018]
    assert got[3] == 0.0


def test_moving_average(bars):
    got = values(indicators.moving_average(bars, 5), "sma_5")
    assert got == pytest.approx([10, 10.5, 33.1 / 3, 11.3, 10.976, 10.976, 10.976, 10.956])


def test_rolling_volatility(bars):
    got = values(indicators.rolling_volatility(bars, 3), "sd_3")
    assert got[0] is None
    # 10, 11: mean 10.5, squares 0.25 + 0.25 over 1; then 12.1, 12.1, 9.68: variance 1.952133
    assert got[1] == pytest.approx(0.5**0.5)
    assert got[4] == pytest.approx((1.9521333333) ** 0.5)


def test_rolling_high_low(bars):
    got = indicators.rolling_high_low(bars, 3)
    assert values(got, "range_high_c")[-1] == 1220
    assert values(got, "range_low_c")[-1] == 970
    assert values(got, "range_position")[-1] == pytest.approx(230 / 250)


def test_indexed_close(bars):
    assert values(indicators.indexed_close(bars), "index_100") == pytest.approx(
        [100, 110, 121, 121, 96.8, 100, 110, 120]
    )


def test_drawdown(bars):
    assert values(indicators.drawdown(bars), "drawdown") == pytest.approx(
        [0, 0, 0, 0, -0.2, -210 / 1210, -110 / 1210, -10 / 1210]
    )


def test_date_gaps(bars):
    got = indicators.date_gaps(bars, limit_days=2)
    assert values(got, "gap_days") == [None, 1, 1, 1, 3, 1, 1, 1]
    assert values(got, "is_gap") == [False] * 4 + [True] + [False] * 3


def test_calendar_fill(bars):
    got = indicators.calendar_fill(bars)
    assert values(got, "close_c") == CLOSES[:4] + [1210, 1210] + CLOSES[4:]
    assert values(got, "filled") == [False] * 4 + [True, True] + [False] * 4


def test_true_range(bars):
    assert values(indicators.true_range(bars), "true_range_c") == [50, 120, 130, 50, 272, 52, 120, 120]


def test_volume_stats(make_bars):
    got = indicators.volume_stats(
        make_bars([("ABC", day, 1, 1, 1, 1, v) for day, v in zip(DAYS[:3], [10, 10, 100])]), rows=2
    )
    assert values(got, "mean_volume") == [10, 10, 55]
    assert values(got, "is_spike") == [False, False, False]
    assert values(got, "volume_ratio")[2] == pytest.approx(100 / 55)


def test_weekly_bars(bars):
    rows = bar_ops.resample(bars, "week").orderBy("period_start").collect()
    first, second = [tuple(row)[1:] for row in rows]
    assert first == (datetime.date(2024, 1, 1), 1000, 1230, 970, 1210, 400, 4)
    assert second == (datetime.date(2024, 1, 8), 968, 1220, 938, 1200, 400, 4)


def test_summary_stats(bars):
    row = indicators.summary_stats(bars).first()
    assert (row.n, row.min_close, row.max_close) == (8, 9.68, 12.1)
    assert row.mean_close == pytest.approx(10.985)
    # Sorted: 9.68 10 10 11 11 12 12.1 12.1; quartile positions 1.75, 3.5, 5.25.
    assert (row.q1_close, row.q2_close, row.q3_close) == pytest.approx((10.0, 11.0, 12.025))


def test_weekday_effect(bars):
    got = {row.weekday: (row.n, row.mean_ret) for row in indicators.weekday_effect(bars).collect()}
    assert got[0] == (1, -0.2)
    assert got[3] == (2, pytest.approx((0.1 + 100 / 1100) / 2, abs=1e-9))


def test_chart_line(bars):
    rows = charts.chart_line(bars, points=4).orderBy("bucket").collect()
    assert [(r.first_close, r.min_close, r.max_close, r.last_close) for r in rows] == [
        (10.0, 10.0, 11.0, 11.0), (12.1, 12.1, 12.1, 12.1), (9.68, 9.68, 10.0, 10.0), (11.0, 11.0, 12.0, 12.0),
    ]


def test_chart_histogram(bars):
    rows = charts.chart_histogram(bars, low_c=1000, high_c=1200, bins=2).collect()
    assert {r.bin: (r.n, r.bin_low) for r in rows} == {
        0: (1, None), 1: (2, 1000.0), 2: (2, 1100.0), 3: (3, 1200.0),
    }


def test_chart_box(bars):
    row = charts.chart_box(bars, "close_c", whisker=0.1).first()
    # Quartiles 1000, 1100, 1202.5; reach 20.25, so 968 alone lies outside.
    assert (row.q1, row.q2, row.q3) == (1000.0, 1100.0, 1202.5)
    assert (row.whisker_low, row.whisker_high, row.n_outliers) == (1000, 1210, 1)


def test_labels_and_lags(bars):
    got = forecast.features(bars)
    assert values(got, "label") == [11.0, 12.1, 12.1, 9.68, 10.0, 11.0, 12.0, None]
    assert values(got, "x2") == [None, 10.0, 11.0, 12.1, 12.1, 9.68, 10.0, 11.0]


def test_chrono_split(bars):
    got = forecast.chrono_split(forecast.features(bars), datetime.date(2024, 1, 8))
    # 5 January's label is 8 January's close, so it belongs to neither side.
    assert values(got, "split") == ["train"] * 3 + ["purged"] + ["test"] * 3 + ["forecast"]


def test_walk_forward(bars):
    got = values(forecast.walk_forward(bars, min_pairs=3), "slope")
    assert got[:3] == [None, None, None]
    assert got[3] == pytest.approx(34100 / 66200)


def test_top_movers(make_bars):
    rows = []
    for symbol, last in [("A", 110), ("B", 120), ("C", 120), ("D", 90)]:
        rows += [(symbol, "2024-01-02", 100, 100, 100, 100, 1), (symbol, "2024-01-03", 1, 1, 1, last, 1)]
    got = indicators.top_movers(make_bars(rows), k=2).orderBy("place").collect()
    assert [(r.symbol, r.place) for r in got] == [("B", 1), ("C", 2)]


def test_zero_price_gives_null_not_error(make_bars):
    bars = make_bars([("Z", "2024-01-02", 0, 0, 0, 0, 0), ("Z", "2024-01-03", 5, 5, 5, 5, 0)])
    assert values(indicators.daily_return(bars), "ret") == [None, None]
    assert values(indicators.log_return(bars), "log_ret") == [None, None]
    assert values(indicators.drawdown(bars), "drawdown") == [None, 0.0]
    assert values(indicators.volume_stats(bars), "is_spike") == [False, False]
