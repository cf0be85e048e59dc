"""Reading, checking, landing and merging price data."""

import datetime
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import bitemporal, history, indicators, quality
from barloom.plans import fixtures
from barloom.plans.registry import query
from barloom.plans.sql import BARS, EVENT_BARS, RETURNS, SNAPSHOTS, SUPPLIER_BARS
from barloom.sources import landing, price_csv
from barloom.sources.scratch import materialize, new_path
from barloom.sources.tables import order_bars, supplier_bars
from barloom.streaming import daily_ingest as daily
from barloom.streaming import known_history
from barloom.streaming import tick_bars

FETCH = ["fetch_date"]

_VALUES = "open_c, high_c, low_c, close_c, volume"

_MERGED = f"""with {BARS}, {SNAPSHOTS}
  select * from new_snapshot
  union all
  select o.* from old_snapshot o anti join new_snapshot n using (symbol, trade_date)"""


@query("csv_roundtrip", f"with {BARS} select * from bars")
def csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "csv")
    bars = order_bars(spark, sf_dir).withColumn("fetch_date", F.lit(fixtures.OLD_FETCH))
    price_csv.write_prices(bars, path)
    return quality.to_bars(price_csv.read_prices(spark, path))


@query("parse_payloads", f"with {BARS} select * from bars")
def parse_payloads(spark, sf_dir):
    bodies = price_csv.to_payloads(
        fixtures.clean_lines(order_bars(spark, sf_dir)), "symbol", "fetch_date"
    )
    return quality.to_bars(price_csv.parse_payloads(bodies))


def _faulty_bodies(bars: DataFrame) -> DataFrame:
    return price_csv.to_payloads(fixtures.faulty_lines(bars), "symbol", "fetch_date")


def _checked(bodies: DataFrame) -> DataFrame:
    return quality.classify(price_csv.parse_payloads(bodies), order=["line_no"], fetch=FETCH)


@query(
    "quarantine",
    f"""with {BARS}, d as (select day(trade_date) as dom from bars)
      select reason, count(*) as n_rows
      from (select 'accepted' as reason from d where dom not in (3, 6, 9, 12, 15)
            union all select 'unparsable' from d where dom = 3
            union all select 'null_price' from d where dom = 6
            union all select 'high_below_low' from d where dom = 9
            union all select 'open_out_of_range' from d where dom = 9
            union all select 'close_out_of_range' from d where dom in (9, 12)
            union all select 'negative_volume' from d where dom = 15
            union all select 'duplicate_key' from d where dom in (18, 21))
      group by reason""",
)
def quarantine(spark, sf_dir):
    return quality.reason_counts(_checked(_faulty_bodies(order_bars(spark, sf_dir))))


@query(
    "quarantine_accepted",
    f"with {BARS} select * from bars where day(trade_date) not in (3, 6, 9, 12, 15)",
)
def quarantine_accepted(spark, sf_dir):
    raw = price_csv.parse_payloads(_faulty_bodies(order_bars(spark, sf_dir)))
    sound, _ = quality.validate(raw, order=["line_no"], fetch=FETCH)
    return quality.to_bars(sound)


@query(
    "land_snapshot",
    f"""with {BARS}, {SNAPSHOTS}
      select * from bars where symbol not in ('1-URGENT', '2-HIGH')
      union all
      select * from restated where symbol in ('1-URGENT', '2-HIGH')""",
)
def land_snapshot(spark, sf_dir):
    """A landing of all bars, then a refetch of two symbols with restated prices, landed twice."""
    path = new_path(spark, "landed")
    bars = materialize(order_bars(spark, sf_dir), "bars")
    refetched = fixtures.restated(bars).where(F.col("symbol").isin("1-URGENT", "2-HIGH"))
    landing.land(bars, path)
    landing.land(refetched, path)
    landing.land(refetched, path)
    return landing.read_landed(spark, path)


@query(
    "bucketed_returns",
    f"""with {SUPPLIER_BARS}, {RETURNS} select symbol, trade_date, close_c, ret from returns""",
)
def bucketed_returns(spark, sf_dir):
    """Returns over bars kept bucketed by symbol: no shuffle when they are read."""
    path = new_path(spark, "bucketed")
    table = "barloom_" + path.rsplit("-", 1)[1]
    bars = materialize(supplier_bars(spark, sf_dir), "bars")
    landing.save_bucketed(bars, table, path, landing.buckets_for(bars))
    returns = indicators.daily_return(spark.table(table))
    spark.sql(f"drop table {table}")  # leaves the files, which the result reads
    return returns.select("symbol", "trade_date", "close_c", "ret")


@query("merge_latest", _MERGED)
def merge_latest(spark, sf_dir):
    bars = order_bars(spark, sf_dir)
    return history.merge(fixtures.old_snapshot(bars), fixtures.new_snapshot(bars))


@query(
    "snapshot_diff",
    f"""with {BARS}, {SNAPSHOTS}
      select symbol, trade_date,
             case when o.close_c is null then 'added' when n.close_c is null then 'dropped'
                  when o.close_c = n.close_c then 'same' else 'revised' end as status,
             o.close_c as old_close_c, n.close_c as new_close_c,
             cast(n.close_c as double) / nullif(cast(o.close_c as double), 0) - 1 as close_change
      from old_snapshot o full outer join new_snapshot n using (symbol, trade_date)""",
)
def snapshot_diff(spark, sf_dir):
    bars = order_bars(spark, sf_dir)
    return history.snapshot_diff(fixtures.old_snapshot(bars), fixtures.new_snapshot(bars))


@query("daily_ingest", _MERGED)
def daily_ingest(spark, sf_dir):
    """Two days of the job, the second with restated prices; a third finds nothing new."""
    files, store = new_path(spark, "files"), new_path(spark, "store")
    bars = materialize(order_bars(spark, sf_dir), "bars")
    for fetch_date, snapshot in [
        (fixtures.OLD_FETCH, fixtures.old_snapshot(bars)),
        (fixtures.NEW_FETCH, fixtures.new_snapshot(bars)),
    ]:
        price_csv.write_prices(snapshot.withColumn("fetch_date", F.lit(fetch_date)), files)
        daily.run_daily(spark, files, store, fetch_date)
    daily.run_daily(spark, files, store, fixtures.NEW_FETCH)
    return daily.read_history(spark, store)


def _store_of_bodies(spark, sf_dir) -> str:
    """Two fetches, the second with restated prices, and one whose responses are errors though they hold prices."""
    store = new_path(spark, "store")
    bars = materialize(order_bars(spark, sf_dir), "bars")
    for fetch_date, snapshot, status in [
        (fixtures.OLD_FETCH, fixtures.old_snapshot(bars), 200),
        (fixtures.NEW_FETCH, fixtures.new_snapshot(bars), 200),
        (fixtures.BROKEN_FETCH, bars, 503),
    ]:
        bodies = price_csv.to_payloads(fixtures.snapshot_lines(snapshot, fetch_date), "symbol", "fetch_date")
        daily.run_payloads(spark, bodies.withColumn("status", F.lit(status)), store, fetch_date)
    return store


@query("payload_ingest", _MERGED)
def payload_ingest(spark, sf_dir):
    return daily.read_history(spark, _store_of_bodies(spark, sf_dir))


@query(
    "payload_runs",
    f"""with {BARS}, {SNAPSHOTS}
      select date '2001-01-01' as run_date, 'ok' as status, '' as reason,
             count(*) as rows_in, count(*) as rows_ok, cast(0 as bigint) as rows_rejected from old_snapshot
      union all
      select date '2002-01-01', 'ok', '', count(*), count(*), 0 from new_snapshot
      union all
      select date '2003-01-01', 'failed', 'no acceptable row', count(*), 0, count(*) from bars""",
)
def payload_runs(spark, sf_dir):
    return daily.read_runs(spark, _store_of_bodies(spark, sf_dir)).drop("run_id")


@query(
    "run_log",
    f"""with {BARS},
      d as (select make_date(year(trade_date), 12, 31) as run_date, day(trade_date) as dom,
                   case when day(trade_date) in (18, 21) then 2 else 1 end as n
            from bars),
      c as (select run_date, cast(sum(n) as bigint) as rows_in,
                   count(*) filter (where dom not in (3, 6, 9, 12, 15)) as rows_ok
            from d group by run_date
            union all
            select date '2002-12-31', count(distinct symbol), 0 from bars)
      select cast(run_date as varchar) as run_id, run_date,
             case when rows_in = 0 then 'empty' when rows_ok > 0 then 'ok' else 'failed' end as status,
             case when rows_in = 0 then 'no rows delivered' when rows_ok = 0 then 'no acceptable row'
                  when rows_in > rows_ok then 'some rows rejected' else '' end as reason,
             rows_in, rows_ok, rows_in - rows_ok as rows_rejected
      from c""",
)
def run_log(spark, sf_dir):
    fetched = materialize(_faulty_bodies(order_bars(spark, sf_dir)), "bodies")
    bodies = fetched.unionByName(fixtures.error_bodies(fetched))
    run_id = F.col("fetch_date").cast("string").alias("run_id")
    runs = bodies.select(run_id, F.col("fetch_date").alias("run_date"))
    checked = _checked(bodies).withColumn("run_id", run_id)
    path = new_path(spark, "runs")
    landing.append_runs(quality.run_log(runs, checked), path)
    return spark.read.parquet(path)


@query("stream_daily_bars", f"with {EVENT_BARS} select * from bars")
def stream_daily_bars(spark, sf_dir):
    store = new_path(spark, "ticks")
    ticks = tick_bars.event_stream(spark, f"{sf_dir}/events.parque[t]")  # a file, or a directory of part files
    tick_bars.store_partial_bars(ticks, store)
    return tick_bars.combine_bars(spark, store)


#: Orders of the columns, as header name and column; the second has a column more, under its own name.
_ORDERS = [
    {"Volume": "volume", "Close": "close", "Date": "trade_date", "Open": "open", "High": "high", "Low": "low"},
    {"timestamp": "trade_date", "open": "open", "high": "high", "low": "low", "close": "close", "adjusted_close": "close", "vol": "volume"},
    {"trade_date": "trade_date", "low": "low", "high": "high", "open": "open", "close": "close", "volume": "volume"},
]


@query("csv_by_name", f"with {BARS} select * from bars")
def csv_by_name(spark, sf_dir):
    """Files of three orders of columns below one path, read in one."""
    path = new_path(spark, "csv")
    bars = materialize(order_bars(spark, sf_dir).withColumn("fetch_date", F.lit(fixtures.OLD_FETCH)), "bars")
    which = F.pmod(F.year("trade_date"), F.lit(len(_ORDERS)))
    for i, columns in enumerate(_ORDERS):
        price_csv.write_prices(bars.where(which == i), path, columns)
    good, _ = quality.validate(price_csv.read_named(spark, path), order=["source_file"], fetch=FETCH)
    return quality.to_bars(good)


# A third fetch, dated between the two of SNAPSHOTS, brings the bars up to mid-2000 with prices two cents higher.
_FETCHES = f"""{SNAPSHOTS},
fetches as (
  select *, date '2001-01-01' as fetch_date from old_snapshot
  union all select *, date '2002-01-01' from new_snapshot
  union all
  select symbol, trade_date, open_c + 2, high_c + 2, low_c + 2, close_c + 2, volume, date '2001-06-01'
  from bars where trade_date <= date '2000-06-30'),
days as (select unnest([date '2000-12-31', date '2001-01-01', date '2001-07-01', date '2002-01-01', date '2003-01-01']) as as_of)
"""


def _late_snapshot(bars: DataFrame) -> DataFrame:
    early = bars.where(F.col("trade_date") <= F.lit("2000-06-30").cast("date"))
    return early.withColumns({name: F.col(name) + 2 for name in ["open_c", "high_c", "low_c", "close_c"]})


def _fetches(bars: DataFrame) -> list:
    """(fetch date, bars), the one dated second coming last."""
    return [
        (fixtures.OLD_FETCH, fixtures.old_snapshot(bars)),
        (fixtures.NEW_FETCH, fixtures.new_snapshot(bars)),
        (datetime.date(2001, 6, 1), _late_snapshot(bars)),
    ]


@query(
    "bar_versions",
    f"""with {BARS}, {_FETCHES}, d as (
        select *, lag(row({_VALUES})) over (partition by symbol, trade_date order by fetch_date) as previous from fetches)
      select symbol, trade_date, {_VALUES}, fetch_date as known_from,
             lead(fetch_date) over (partition by symbol, trade_date order by fetch_date) as known_to
      from d where previous is null or previous <> row({_VALUES})""",
)
def bar_versions(spark, sf_dir):
    """Every state of every bar; made of two fetches, then extended by a third."""
    bars = materialize(order_bars(spark, sf_dir), "bars")
    dated = {day: snapshot.withColumn("fetch_date", F.lit(day)) for day, snapshot in _fetches(bars)}
    first, late, last = (dated[day] for day in sorted(dated))
    so_far = materialize(bitemporal.versions(first.unionByName(late)), "versions")
    return bitemporal.extend(so_far, last)


@query(
    "bars_as_known",
    f"""with {BARS}, {_FETCHES}
      select as_of, symbol, trade_date, max_by(open_c, fetch_date) as open_c, max_by(high_c, fetch_date) as high_c,
             max_by(low_c, fetch_date) as low_c, max_by(close_c, fetch_date) as close_c, max_by(volume, fetch_date) as volume
      from fetches join days on fetch_date <= as_of group by as_of, symbol, trade_date""",
)
def bars_as_known(spark, sf_dir):
    """The daily store on five days, fed by three runs of which the last brings a fetch dated before the second."""
    files, store = new_path(spark, "files"), new_path(spark, "store")
    bars = materialize(order_bars(spark, sf_dir), "bars")
    for fetch_date, snapshot in _fetches(bars):
        price_csv.write_prices(snapshot.withColumn("fetch_date", F.lit(fetch_date)), files)
        daily.run_daily(spark, files, store, fetch_date)
        known_history.refresh_known(spark, store)
    versions = known_history.read_versions(spark, store)
    days = [datetime.date(2000, 12, 31), *sorted(day for day, _ in _fetches(bars)), datetime.date(2003, 1, 1)]
    days[2] = datetime.date(2001, 7, 1)
    found = [bitemporal.as_known(versions, day).withColumn("as_of", F.lit(day)) for day in days]
    return functools.reduce(DataFrame.unionByName, found)
