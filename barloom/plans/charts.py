"""Chart-ready tables."""

from barloom.functions.columns import round_columns
from barloom.operators import charts
from barloom.operators.indicators import daily_return
from barloom.plans.registry import query
from barloom.plans.sql import BARS, RETURNS, SUPPLIER_BARS
from barloom.sources.tables import order_bars, supplier_bars


@query(
    "chart_line",
    f"""with {BARS}
      select symbol, cast(bucket as integer) as bucket, min(trade_date) as from_date,
             max(trade_date) as to_date,
             cast(min_by(close_c, trade_date) as double) / 100 as first_close,
             cast(min(close_c) as double) / 100 as min_close,
             cast(max(close_c) as double) / 100 as max_close,
             cast(max_by(close_c, trade_date) as double) / 100 as last_close
      from (select *, ntile(50) over (partition by symbol order by trade_date) as bucket from bars)
      group by 1, 2""",
)
def chart_line(spark, sf_dir):
    return charts.chart_line(order_bars(spark, sf_dir), points=50)


@query(
    "chart_histogram",
    f"""with {BARS}
      select symbol, bin, count(*) as n,
             case when bin > 0 then cast((bin - 1) * 48000000 as double) / 24 end as bin_low
      from (select symbol,
              case when close_c < 0 then 0 when close_c >= 48000000 then 25
                   else cast(floor(cast(close_c as double) * 24 / 48000000) as bigint) + 1 end as bin
            from bars)
      group by symbol, bin""",
)
def chart_histogram(spark, sf_dir):
    return charts.chart_histogram(order_bars(spark, sf_dir), low_c=0, high_c=48_000_000, bins=24)


@query(
    "chart_box",
    f"""with {BARS}, {RETURNS},
      q as (select symbol, quantile_cont(ret, 0.25) as q1, quantile_cont(ret, 0.5) as q2,
                   quantile_cont(ret, 0.75) as q3
            from returns where ret is not null group by symbol),
      f as (select symbol, ret, q1, q2, q3,
                   ret >= q1 - 1.5 * (q3 - q1) and ret <= q3 + 1.5 * (q3 - q1) as inside
            from returns join q using (symbol) where ret is not null)
      select symbol, count(*) as n, round(first(q1), 9) as q1, round(first(q2), 9) as q2,
             round(first(q3), 9) as q3,
             round(min(ret) filter (where inside), 9) as whisker_low,
             round(max(ret) filter (where inside), 9) as whisker_high,
             count(*) filter (where not inside) as n_outliers
      from f group by symbol""",
)
def chart_box(spark, sf_dir):
    box = charts.chart_box(daily_return(order_bars(spark, sf_dir)), "ret", whisker=1.5)
    return round_columns(box, 9, "q1", "q2", "q3", "whisker_low", "whisker_high")


@query(
    "chart_correlation",
    f"""with {SUPPLIER_BARS}, {RETURNS},
      r as (select symbol, trade_date, ret from returns where ret is not null)
      select a.symbol as symbol_a, b.symbol as symbol_b, count(*) as n,
             round(corr(a.ret, b.ret), 9) + 0.0 as correlation
      from r a join r b on a.trade_date = b.trade_date and a.symbol < b.symbol
      group by 1, 2 having count(*) >= 3""",
)
def chart_correlation(spark, sf_dir):
    return charts.chart_correlation(supplier_bars(spark, sf_dir)).where("n >= 3")  # the SQL lists no others


_DENSITY_POINTS, _DENSITY_BINS = 64, 256


@query(
    "chart_density",
    f"""with {BARS},
      m as (select symbol, min(close_c) as least, max(close_c) as most, count(*) as n,
                   1.06 * (sqrt(cast(cast(count(*) as hugeint) * sum(cast(close_c as hugeint) * close_c)
                     - sum(cast(close_c as hugeint)) * sum(cast(close_c as hugeint)) as double)
                     / cast(count(*) * (count(*) - 1) as double)) / 100) * 100 * pow(cast(count(*) as double), -0.2) as width
            from bars group by symbol),
      binned as (select symbol, ((close_c - least) * least({_DENSITY_BINS}, most - least + 1)) // (most - least + 1) as bin, count(*) as held
                 from bars join m using (symbol) group by 1, 2),
      grid as (select *, least + point * cast(most - least as double) / {_DENSITY_POINTS - 1} as "at"
               from m, (select unnest(range({_DENSITY_POINTS})) as point))
      select symbol, round("at", 6) as "at",
        round(sum(held * exp(-0.5 * pow(("at" - (least + (bin + 0.5) * (cast(most - least as double) + 1) / least({_DENSITY_BINS}, most - least + 1) - 0.5)) / width, 2)))
              / (any_value(n) * any_value(width) * sqrt(2 * pi())), 15) as density
      from grid join binned using (symbol) group by symbol, point, "at" """,
)
def chart_density(spark, sf_dir):
    smooth = charts.chart_density(order_bars(spark, sf_dir), "close_c", _DENSITY_POINTS, _DENSITY_BINS)
    return round_columns(round_columns(smooth, 6, "at"), 15, "density")


@query(
    "chart_bins_2d",
    f"""with {BARS},
      m as (select symbol, min(close_c) as c0, max(close_c) as c1, min(volume) as v0, max(volume) as v1 from bars group by symbol)
      select symbol, cast(((close_c - c0) * least(16, c1 - c0 + 1)) // (c1 - c0 + 1) as integer) as x_bin,
             cast(((volume - v0) * least(16, v1 - v0 + 1)) // (v1 - v0 + 1) as integer) as y_bin, count(*) as n
      from bars join m using (symbol) group by 1, 2, 3""",
)
def chart_bins_2d(spark, sf_dir):
    return charts.chart_bins_2d(order_bars(spark, sf_dir), "close_c", "volume", 16)
