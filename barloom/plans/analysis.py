"""Bars and per-symbol analysis."""

from pyspark.sql import DataFrame

from barloom.operators import indicators
from barloom.operators.bars import resample
from barloom.plans.registry import query
from barloom.plans.sql import BARS, RETURNS, SUPPLIER_BARS
from barloom.sources.tables import order_bars, supplier_bars

KEY = ["symbol", "trade_date"]


def _on_bars(name: str, operator, columns: list[str], sql: str) -> None:
    """Register an operator over the order bars, showing the key and ``columns``.

    ``sql`` selects the same from CTEs ``bars`` and ``returns``."""

    def run(spark, sf_dir) -> DataFrame:
        return operator(order_bars(spark, sf_dir)).select(*KEY, *columns)

    query(name, f"with {BARS}, {RETURNS} {sql}")(run)


_DAY = "(partition by symbol order by trade_date)"


def _rows(n: int) -> str:
    return f"(partition by symbol order by trade_date rows between {n - 1} preceding and current row)"


@query("daily_bars", f"with {BARS} select * from bars")
def daily_bars(spark, sf_dir):
    return order_bars(spark, sf_dir)


@query("supplier_daily_bars", f"with {SUPPLIER_BARS} select * from bars")
def supplier_daily_bars(spark, sf_dir):
    return supplier_bars(spark, sf_dir)


def _resample_sql(unit: str) -> str:
    return f"""with {BARS}
      select symbol, cast(date_trunc('{unit}', trade_date) as date) as period_start,
             min_by(open_c, trade_date) as open_c, max(high_c) as high_c, min(low_c) as low_c,
             max_by(close_c, trade_date) as close_c, cast(sum(volume) as bigint) as volume,
             count(*) as n_days
      from bars group by 1, 2"""


@query("weekly_bars", _resample_sql("week"))
def weekly_bars(spark, sf_dir):
    return resample(order_bars(spark, sf_dir), "week")


@query("monthly_bars", _resample_sql("month"))
def monthly_bars(spark, sf_dir):
    return resample(order_bars(spark, sf_dir), "month")


_on_bars(
    "daily_return", indicators.daily_return, ["close_c", "ret"],
    "select symbol, trade_date, close_c, ret from returns",
)

_on_bars(
    "log_return", indicators.log_return, ["log_ret"],
    f"""select symbol, trade_date,
          case when close_c > 0 and prev_c > 0
               then round(ln(cast(close_c as double) / cast(prev_c as double)), 9) + 0.0 end as log_ret
        from (select *, lag(close_c) over {_DAY} as prev_c from bars)""",
)

_on_bars(
    "moving_average", lambda bars: indicators.moving_average(bars, 5, 20), ["sma_5", "sma_20"],
    f"""select symbol, trade_date,
          cast(sum(close_c) over five as double) / count(*) over five / 100 as sma_5,
          cast(sum(close_c) over twenty as double) / count(*) over twenty / 100 as sma_20
        from bars window five as {_rows(5)}, twenty as {_rows(20)}""",
)

_on_bars(
    "rolling_volatility", indicators.rolling_volatility, ["sd_20"],
    f"""select symbol, trade_date,
          case when n > 1 then sqrt(cast(n * s2 - s1 * s1 as double) / cast(n * (n - 1) as double)) / 100
          end as sd_20
        from (select symbol, trade_date, cast(count(*) over f as hugeint) as n,
                     sum(cast(close_c as hugeint)) over f as s1,
                     sum(cast(close_c as hugeint) * close_c) over f as s2
              from bars window f as {_rows(20)})""",
)

_on_bars(
    "rolling_high_low", indicators.rolling_high_low,
    ["range_high_c", "range_low_c", "range_position"],
    f"""select symbol, trade_date, range_high_c, range_low_c,
          cast(close_c - range_low_c as double)
            / nullif(cast(range_high_c - range_low_c as double), 0) as range_position
        from (select *, max(high_c) over f as range_high_c, min(low_c) over f as range_low_c
              from bars window f as {_rows(20)})""",
)

_on_bars(
    "yearly_high_low", lambda bars: indicators.rolling_high_low(bars, 252),
    ["range_high_c", "range_low_c", "range_position"],
    f"""select symbol, trade_date, range_high_c, range_low_c,
          cast(close_c - range_low_c as double)
            / nullif(cast(range_high_c - range_low_c as double), 0) as range_position
        from (select *, max(high_c) over f as range_high_c, min(low_c) over f as range_low_c
              from bars window f as {_rows(252)})""",
)

_on_bars(
    "indexed_close", indicators.indexed_close, ["index_100"],
    f"""select symbol, trade_date,
          cast(close_c as double) / nullif(cast(first_value(close_c) over {_DAY} as double), 0) * 100
            as index_100
        from bars""",
)

_on_bars(
    "drawdown", indicators.drawdown, ["peak_c", "drawdown"],
    f"""select symbol, trade_date, peak_c,
          cast(close_c as double) / nullif(cast(peak_c as double), 0) - 1 as drawdown
        from (select *, max(close_c) over {_DAY} as peak_c from bars)""",
)

_on_bars(
    "date_gaps", indicators.date_gaps, ["gap_days", "is_gap"],
    """select symbol, trade_date, cast(gap as integer) as gap_days, coalesce(gap > 4, false) as is_gap
       from (select symbol, trade_date, datediff('day', lag(trade_date) over
               (partition by symbol order by trade_date), trade_date) as gap from bars)""",
)

_on_bars(
    "calendar_fill", indicators.calendar_fill, ["close_c", "filled"],
    """, span as (
         select symbol, cast(unnest(generate_series(cast(min(trade_date) as timestamp),
           cast(max(trade_date) as timestamp), interval 1 day)) as date) as trade_date
         from bars group by symbol)
       select symbol, trade_date,
              last_value(close_c ignore nulls) over (partition by symbol order by trade_date
                rows between unbounded preceding and current row) as close_c,
              close_c is null as filled
       from span left join bars using (symbol, trade_date)""",
)

_on_bars(
    "true_range", indicators.true_range, ["true_range_c"],
    f"""select symbol, trade_date,
          greatest(high_c - low_c, abs(high_c - prev_c), abs(low_c - prev_c)) as true_range_c
        from (select *, lag(close_c) over {_DAY} as prev_c from bars)""",
)

_on_bars(
    "volume_stats", indicators.volume_stats, ["mean_volume", "volume_ratio", "is_spike"],
    f"""select symbol, trade_date, mean_volume,
          cast(volume as double) / nullif(mean_volume, 0) as volume_ratio,
          coalesce(cast(volume as double) / nullif(mean_volume, 0) >= 2.0, false) as is_spike
        from (select *, cast(sum(volume) over f as double) / count(*) over f as mean_volume
              from bars window f as {_rows(20)})""",
)


@query(
    "top_movers",
    f"""with {SUPPLIER_BARS}, {RETURNS}
      select trade_date, symbol, ret, cast(place as integer) as place
      from (select *, row_number() over (partition by trade_date order by ret desc, symbol) as place
            from returns where ret is not null)
      where place <= 3""",
)
def top_movers(spark, sf_dir):
    return indicators.top_movers(supplier_bars(spark, sf_dir), k=3)


@query(
    "summary_stats",
    f"""with {BARS}
      select symbol, n, min_c / 100 as min_close, max_c / 100 as max_close,
             cast(s1 as double) / n / 100 as mean_close,
             case when n > 1 then sqrt(cast(cast(n as hugeint) * s2 - s1 * s1 as double)
               / cast(n * (n - 1) as double)) / 100 end as sd_close,
             q1 / 100 as q1_close, q2 / 100 as q2_close, q3 / 100 as q3_close
      from (select symbol, count(*) as n, cast(min(close_c) as double) as min_c,
                   cast(max(close_c) as double) as max_c,
                   sum(cast(close_c as hugeint)) as s1, sum(cast(close_c as hugeint) * close_c) as s2,
                   quantile_cont(cast(close_c as double), 0.25) as q1,
                   quantile_cont(cast(close_c as double), 0.5) as q2,
                   quantile_cont(cast(close_c as double), 0.75) as q3
            from bars group by symbol)""",
)
def summary_stats(spark, sf_dir):
    return indicators.summary_stats(order_bars(spark, sf_dir))


def _effect_sql(unit: str, expression: str) -> str:
    return f"""with {BARS}, {RETURNS}
      select symbol, cast({expression} as integer) as {unit}, count(*) as n,
             round(avg(ret), 9) + 0.0 as mean_ret
      from returns where ret is not null group by 1, 2"""


@query("weekday_effect", _effect_sql("weekday", "isodow(trade_date) - 1"))
def weekday_effect(spark, sf_dir):
    return indicators.weekday_effect(order_bars(spark, sf_dir))


@query("month_effect", _effect_sql("month", "month(trade_date)"))
def month_effect(spark, sf_dir):
    return indicators.month_effect(order_bars(spark, sf_dir))


@query(
    "indicator_panel",
    f"""with {SUPPLIER_BARS},
      w as (
        select *, lag(close_c) over d as prev_c, lag(trade_date) over d as prev_date,
          first_value(close_c) over d as first_c, max(close_c) over d as peak_c,
          sum(close_c) over f5 as s5, count(*) over f5 as n5,
          cast(count(*) over f20 as hugeint) as n, sum(cast(close_c as hugeint)) over f20 as s1,
          sum(cast(close_c as hugeint) * close_c) over f20 as s2,
          max(high_c) over f20 as range_high_c, min(low_c) over f20 as range_low_c,
          cast(sum(volume) over f20 as double) / count(*) over f20 as mean_volume
        from bars
        window d as {_DAY}, f5 as {_rows(5)}, f20 as {_rows(20)})
      select symbol, trade_date, close_c,
        cast(close_c as double) / nullif(cast(prev_c as double), 0) - 1 as ret,
        cast(s5 as double) / n5 / 100 as sma_5,
        cast(s1 as double) / cast(n as double) / 100 as sma_20,
        case when n > 1 then sqrt(cast(n * s2 - s1 * s1 as double) / cast(n * (n - 1) as double)) / 100
        end as sd_20,
        cast(close_c - range_low_c as double)
          / nullif(cast(range_high_c - range_low_c as double), 0) as range_position,
        cast(close_c as double) / nullif(cast(first_c as double), 0) * 100 as index_100,
        cast(close_c as double) / nullif(cast(peak_c as double), 0) - 1 as drawdown,
        greatest(high_c - low_c, abs(high_c - prev_c), abs(low_c - prev_c)) as true_range_c,
        cast(datediff('day', prev_date, trade_date) as integer) as gap_days,
        cast(volume as double) / nullif(mean_volume, 0) as volume_ratio
      from w""",
)
def indicator_panel(spark, sf_dir):
    """The indicators side by side over many symbols: one shuffle and one sort by symbol."""
    bars = supplier_bars(spark, sf_dir)
    for add in [
        indicators.daily_return,
        lambda rows: indicators.moving_average(rows, 5, 20),
        indicators.rolling_volatility,
        indicators.rolling_high_low,
        indicators.indexed_close,
        indicators.drawdown,
        indicators.true_range,
        indicators.date_gaps,
        indicators.volume_stats,
    ]:
        bars = add(bars)
    return bars.select(
        *KEY, "close_c", "ret", "sma_5", "sma_20", "sd_20", "range_position", "index_100",
        "drawdown", "true_range_c", "gap_days", "volume_ratio",
    )
