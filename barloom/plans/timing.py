"""Joins by time, recurrences, sessions, patterns and sketches."""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import ratio, round_columns
from barloom.operators import joins, patterns, recurrences, sessions, sketches
from barloom.operators.bars import daily_bars
from barloom.operators.indicators import date_gaps
from barloom.plans.registry import query
from barloom.plans.sql import BARS, EVENT_BARS, SUPPLIER_BARS
from barloom.sources.scratch import materialize, new_path
from barloom.sources.tables import event_ticks, order_bars, order_ticks, supplier_bars, table
from barloom.streaming import tick_bars, tick_sessions

KEY = ["symbol", "trade_date"]


@query(
    "asof_daily_bar",
    f"""with {EVENT_BARS},
      known as (select symbol as bar_symbol, cast(trade_date as timestamp) + interval 1 day as known_at,
                       trade_date as bar_date, close_c as bar_close_c from bars),
      ticks as (select event_type as symbol, ts, event_id as seq, cast(round(value * 100) as bigint) as price_c from events)
      select symbol, seq, price_c, bar_date, bar_close_c,
             cast(price_c as double) / nullif(cast(bar_close_c as double), 0) - 1 as move
      from ticks asof left join known on symbol = bar_symbol and ts >= known_at""",
)
def asof_daily_bar(spark, sf_dir):
    """Each tick with the newest bar complete at its time, known from the midnight after its day."""
    ticks = event_ticks(table(spark, sf_dir, "events"))
    bars = daily_bars(ticks).select(
        "symbol",
        (F.date_add("trade_date", 1).cast("timestamp_ntz")).alias("known_at"),
        F.col("trade_date").alias("bar_date"),
        F.col("close_c").alias("bar_close_c"),
    )
    joined = joins.asof_join(
        ticks.select("symbol", "ts", "seq", "price_c"), bars, ["symbol"], "ts", "known_at", ["bar_date", "bar_close_c"]
    )
    move = ratio(F.col("price_c"), F.col("bar_close_c")) - 1
    return joined.select("symbol", "seq", "price_c", "bar_date", "bar_close_c", move.alias("move"))


@query(
    "asof_previous_event",
    """with seen as (
         select user_id as other_user, ts as seen_at, max(event_id) as seen_id, max_by(value, event_id) as seen_value
         from events where event_type <> 'purchase' group by 1, 2)
       select event_id, user_id, seen_id, seen_value
       from (select * from events where event_type = 'purchase') p
         asof left join seen on user_id = other_user and ts > seen_at""",
)
def asof_previous_event(spark, sf_dir):
    """Each purchase with what its user did last before it: events to events, many keys."""
    events = table(spark, sf_dir, "events")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = events.where("event_type <> 'purchase'").select(
        "user_id", F.col("ts").alias("seen_at"), F.col("event_id").alias("seen_id"), F.col("value").alias("seen_value")
    )
    return joins.asof_join(
        bought, seen, ["user_id"], "ts", "seen_at", ["seen_id", "seen_value"], strict=True
    ).select("event_id", "user_id", "seen_id", "seen_value")


_DRAWDOWNS = """
drawdowns as (
  select symbol, min(trade_date) as start_date, max(trade_date) as end_date, max(peak_c) as peak_c, min(close_c) as low_c,
         count(*) as n_days
  from (select *, sum(case when close_c >= peak_c then 1 else 0 end) over (partition by symbol order by trade_date) as island
        from (select symbol, trade_date, close_c, max(close_c) over (partition by symbol order by trade_date) as peak_c from bars))
  where close_c < peak_c group by symbol, island)
"""

_EPISODES = f"""{_DRAWDOWNS},
episodes as (
  select symbol, 'drawdown' as kind, start_date, end_date from drawdowns
  union all
  select symbol, 'halt', last_date, trade_date
  from (select symbol, trade_date, lag(trade_date) over (partition by symbol order by trade_date) as last_date from bars)
  where trade_date - last_date > 4
  union all
  select symbol, 'history', min(trade_date), max(trade_date) from bars group by symbol)
"""


def _episodes(bars: DataFrame) -> DataFrame:
    """Drawdowns, halts of over four days with the bars at either end, and each symbol's whole history."""
    drawdowns = joins.under_water(bars).select("symbol", F.lit("drawdown").alias("kind"), "start_date", "end_date")
    halts = date_gaps(bars, 4).where("is_gap").select(
        "symbol", F.lit("halt").alias("kind"), F.date_sub("trade_date", F.col("gap_days")).alias("start_date"),
        F.col("trade_date").alias("end_date"),
    )
    history = bars.groupBy("symbol").agg(F.min("trade_date").alias("start_date"), F.max("trade_date").alias("end_date"))
    return drawdowns.unionByName(halts).unionByName(history.withColumn("kind", F.lit("history")))


@query(
    "drawdown_episodes",
    f"""with {BARS}, {_DRAWDOWNS}
      select *, cast(low_c as double) / nullif(cast(peak_c as double), 0) - 1 as depth from drawdowns""",
)
def drawdown_episodes(spark, sf_dir):
    return joins.under_water(order_bars(spark, sf_dir))


@query(
    "bars_in_episodes",
    f"""with {BARS}, {_EPISODES}
      select b.symbol, trade_date, close_c, kind, start_date, end_date
      from bars b join episodes e on b.symbol = e.symbol and trade_date between start_date and end_date""",
)
def bars_in_episodes(spark, sf_dir):
    """Every bar with every episode of its symbol that it lies in."""
    bars = materialize(order_bars(spark, sf_dir).select(*KEY, "close_c"), "bars")
    episodes = materialize(_episodes(bars), "episodes")
    return joins.interval_join(bars, episodes, ["symbol"], "trade_date", "start_date", "end_date")


@query(
    "episode_stats",
    f"""with {SUPPLIER_BARS}, {_EPISODES}
      select e.symbol, kind, start_date, end_date, count(*) as n_bars, min(low_c) as low_c, max(high_c) as high_c,
             cast(sum(volume) as bigint) as volume, max_by(close_c, trade_date) - min_by(close_c, trade_date) as change_c
      from bars b join episodes e on b.symbol = e.symbol and trade_date between start_date and end_date
      group by e.symbol, kind, start_date, end_date""",
)
def episode_stats(spark, sf_dir):
    """What happened within each episode, over many symbols."""
    bars = materialize(supplier_bars(spark, sf_dir).drop("open_c"), "bars")
    episodes = materialize(_episodes(bars), "episodes")
    met = joins.interval_join(bars, episodes, ["symbol"], "trade_date", "start_date", "end_date")
    return met.groupBy("symbol", "kind", "start_date", "end_date").agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.min("low_c").alias("low_c"),
        F.max("high_c").alias("high_c"),
        F.sum("volume").alias("volume"),
        (F.max_by("close_c", "trade_date") - F.min_by("close_c", "trade_date")).alias("change_c"),
    )


def _weighted_sql(source: str, column: str, keep: str, name: str) -> str:
    """CTE ``name`` (symbol, i, m): the recurrence row by row over ``source`` (symbol, i, column), i from 1."""
    return f"""{name} as (
      select symbol, i, {column} as m from {source} where i = 1
      union all
      select s.symbol, s.i, {keep} * r.m + (1 - {keep}) * s.{column}
      from {name} r join {source} s on s.symbol = r.symbol and s.i = r.i + 1)"""


@query(
    "ew_means",
    f"""with recursive {BARS},
      n as (select symbol, trade_date, cast(close_c as double) / 100 as x,
                   row_number() over (partition by symbol order by trade_date) as i from bars),
      {_weighted_sql("n", "x", "(1 - 2 / 13.0::double)", "f")},
      {_weighted_sql("n", "x", "(1 - 2 / 27.0::double)", "s")},
      d as (select symbol, i, f.m - s.m as y from f join s using (symbol, i)),
      {_weighted_sql("d", "y", "(1 - 2 / 10.0::double)", "g")}
      select symbol, trade_date, round(f.m, 4) as ema_12, round(s.m, 4) as ema_26,
             round(y, 4) + 0.0 as macd, round(g.m, 4) + 0.0 as macd_signal
      from n join f using (symbol, i) join s using (symbol, i) join d using (symbol, i) join g using (symbol, i)""",
)
def ew_means(spark, sf_dir):
    """Two weighted means, their difference and its own weighted mean: scans over scans."""
    measured = recurrences.macd(order_bars(spark, sf_dir))
    names = ["ema_12", "ema_26", "macd", "macd_signal"]
    return round_columns(measured.select(*KEY, *names), 4, *names)


@query(
    "ew_volatility",
    f"""with recursive {BARS},
      n as (select symbol, trade_date, x * x as x, row_number() over (partition by symbol order by trade_date) as i
            from (select symbol, trade_date, cast(close_c as double)
                    / nullif(cast(lag(close_c) over (partition by symbol order by trade_date) as double), 0) - 1 as x from bars)
            where x is not null),
      {_weighted_sql("n", "x", "0.94::double", "v")}
      select b.symbol, b.trade_date, round(sqrt(v.m), 9) as ew_vol
      from bars b left join n using (symbol, trade_date) left join v using (symbol, i)""",
)
def ew_volatility(spark, sf_dir):
    measured = recurrences.ew_volatility(order_bars(spark, sf_dir))
    return round_columns(measured.select(*KEY, "ew_vol"), 9, "ew_vol")


GAP = datetime.timedelta(hours=1)

_SESSIONS = """
  with ticks as (select event_type as symbol, epoch_us(ts) as us, event_id as seq,
                        cast(round(value * 100) as bigint) as price_c from events),
  opened as (select *, case when us - lag(us) over (partition by symbol order by us, seq) <= 3600000000 then 0 else 1 end as opens
             from ticks),
  numbered as (select *, sum(opens) over (partition by symbol order by us, seq) as island from opened)
  select symbol, min(us) as start_us, max(us) as end_us, min_by(price_c, row(us, seq)) as open_c, max(price_c) as high_c,
         min(price_c) as low_c, max_by(price_c, row(us, seq)) as close_c, count(*) as n_ticks
  from numbered group by symbol, island
"""


@query("tick_sessions", _SESSIONS)
def tick_sessions_in_batch(spark, sf_dir):
    return sessions.sessions(event_ticks(table(spark, sf_dir, "events")), GAP)


@query("stream_sessions", _SESSIONS)
def stream_sessions(spark, sf_dir):
    """The sessions of a stream of ticks, stored as parts and merged when read."""
    store = new_path(spark, "sessions")
    ticks = tick_bars.event_stream(spark, f"{sf_dir}/events.parque[t]")  # a file, or a directory of part files
    tick_sessions.store_sessions(ticks, store, GAP)
    return tick_sessions.read_sessions(spark, store, GAP)


@query(
    "price_patterns",
    f"""with {SUPPLIER_BARS},
      moved as (select *, sign(close_c - lag(close_c) over (partition by symbol order by trade_date)) as way from bars),
      turned as (select *, case when way is distinct from lag(way) over (partition by symbol order by trade_date) then 1 else 0 end as turn
                 from moved),
      runs as (
        select symbol, run, any_value(way) as way, count(*) as n, min(trade_date) as first_day, max(trade_date) as last_day,
               min_by(close_c, trade_date) as first_c, min(close_c) as low_c, max(close_c) as high_c, max_by(close_c, trade_date) as last_c
        from (select *, sum(turn) over (partition by symbol order by trade_date) as run from turned) group by symbol, run)
      select d.symbol, repeat('D', d.n) || repeat('U', u.n) as letters, d.first_day as start_date, u.last_day as end_date,
             d.n + u.n as n_days, d.first_c, least(d.low_c, u.low_c) as low_c, greatest(d.high_c, u.high_c) as high_c, u.last_c
      from runs d join runs u on d.symbol = u.symbol and u.run = d.run + 1
      where d.way = -1 and u.way = 1 and d.n >= 3 and u.n >= 2""",
)
def price_patterns(spark, sf_dir):
    """Falls of three days or more that turn into rises of two or more, over many symbols."""
    return patterns.find(supplier_bars(spark, sf_dir))


_RANKS = (0.05, 0.5, 0.95)


@query(
    "quantile_sketches",
    """select o_orderpriority as symbol, cast(date_trunc('year', o_orderdate) as date) as period_start, count(*) as n_ticks,
              true as within
       from orders where o_orderdate is not null group by 1, 2""",
)
def quantile_sketches(spark, sf_dir):
    """Yearly quantiles merged from daily sketches by way of months; whether each rank is within the documented error."""
    ticks = order_ticks(spark, sf_dir).where("trade_date is not null")
    daily = materialize(sketches.daily_sketches(ticks), "sketches")
    yearly = sketches.roll_up(sketches.roll_up(daily, "month"), "year")
    found = materialize(sketches.quantiles(yearly, *_RANKS), "quantiles")
    errors = sketches.rank_errors(ticks, found, "year", *_RANKS)
    within = F.greatest(*[F.col(f"e{round(rank * 100)}") for rank in _RANKS]) <= 2 * sketches.RANK_ERROR
    return errors.select("symbol", "period_start", "n_ticks", within.alias("within"))
