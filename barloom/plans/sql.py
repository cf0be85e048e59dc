"""SQL fragments the oracles share; each is one or more CTEs without WITH."""

_BAR_VALUES = """
    min_by(c, seq) as open_c, max(c) as high_c, min(c) as low_c, max_by(c, seq) as close_c,
    cast(count(*) as bigint) as volume
"""

BARS = f"""
bars as (
  select symbol, trade_date, {_BAR_VALUES}
  from (select o_orderpriority as symbol, cast(o_orderdate as date) as trade_date,
               cast(round(o_totalprice * 100) as bigint) as c, o_orderkey as seq
        from orders)
  group by symbol, trade_date)
"""

SUPPLIER_BARS = f"""
bars as (
  select symbol, trade_date, {_BAR_VALUES}
  from (select cast(l_suppkey as varchar) as symbol, cast(l_shipdate as date) as trade_date,
               cast(round(l_extendedprice * 100) as bigint) as c,
               row(l_orderkey, l_linenumber, l_partkey, l_extendedprice) as seq
        from lineitem)
  group by symbol, trade_date)
"""

EVENT_BARS = f"""
bars as (
  select symbol, trade_date, {_BAR_VALUES}
  from (select event_type as symbol, cast(ts as date) as trade_date,
               cast(round(value * 100) as bigint) as c, event_id as seq
        from events)
  group by symbol, trade_date)
"""

# Daily return on top of a bars CTE.
RETURNS = """
returns as (
  select *, cast(close_c as double)
            / nullif(cast(lag(close_c) over (partition by symbol order by trade_date) as double), 0)
            - 1 as ret
  from bars)
"""

# Two snapshots: the later one restates the prices of Fridays by a cent.
SNAPSHOTS = """
old_snapshot as (select * from bars where trade_date <= date '2000-12-31'),
restated as (
  select symbol, trade_date, open_c + cent as open_c, high_c + cent as high_c,
         low_c + cent as low_c, close_c + cent as close_c, volume
  from (select *, case when isodow(trade_date) = 5 then 1 else 0 end as cent from bars)),
new_snapshot as (select * from restated where trade_date >= date '2000-06-01')
"""

FEATURES = """
features as (
  select symbol, trade_date,
    cast(close_c as double) / 100 as x1,
    cast(lag(close_c, 1) over d as double) / 100 as x2,
    cast(lag(close_c, 2) over d as double) / 100 as x_lag2,
    cast(sum(close_c) over m as double) / count(*) over m / 100 as x_mean5,
    cast(lead(close_c) over d as double) / 100 as label,
    lead(trade_date) over d as label_date
  from bars
  window d as (partition by symbol order by trade_date),
         m as (partition by symbol order by trade_date rows between 4 preceding and current row))
"""

SPLIT = """
split_rows as (
  select *, case when label_date is null then 'forecast'
                 when label_date < date '2000-01-01' then 'train'
                 when trade_date >= date '2000-01-01' then 'test'
                 else 'purged' end as split
  from features)
"""

# Two-feature least squares in closed form: b1, b2 and the means.
OLS = """
train as (select * from split_rows where split = 'train' and x2 is not null),
moments as (
  select avg(x1) as m1, avg(x2) as m2, avg(label) as my,
         covar_pop(x1, x1) as a, covar_pop(x1, x2) as b, covar_pop(x2, x2) as c,
         covar_pop(x1, label) as d, covar_pop(x2, label) as e
  from train),
ols as (
  select m1, m2, my, (c * d - b * e) / (a * c - b * b) as b1, (a * e - b * d) / (a * c - b * b) as b2
  from moments)
"""

PREDICTED = """
predicted as (
  select symbol, trade_date, split, label, x1,
         my + b1 * (x1 - m1) + b2 * (x2 - m2) as prediction
  from split_rows, ols where split in ('test', 'forecast') and x2 is not null)
"""

MODEL = ",".join([BARS, FEATURES, SPLIT, OLS, PREDICTED])


def metrics(source: str) -> str:
    """Scores per symbol and pooled, of a relation (symbol, label, prediction)."""
    one = """
      count(*) as n,
      round(sqrt(avg((prediction - label) * (prediction - label))), 4) as rmse,
      round(avg((prediction - label) * (prediction - label)), 0) as mse,
      round(avg(abs(prediction - label)), 4) as mae,
      round(1 - avg((prediction - label) * (prediction - label)) / var_pop(label), 8) as r2,
      round(var_pop(prediction) + (avg(prediction) - avg(label)) * (avg(prediction) - avg(label)), 0)
        as explained_variance
    """
    return f"""
      select false as pooled, symbol, {one} from {source} where label is not null group by symbol
      union all
      select true as pooled, null as symbol, {one} from {source} where label is not null
    """
