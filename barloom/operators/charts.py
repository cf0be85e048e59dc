"""The tables under the usual price charts, small enough to draw. No drawing here."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import exact, sd_price, square, to_price
from barloom.functions.windows import by_day, whole_symbol
from barloom.operators.indicators import daily_return
from barloom.sources.scratch import materialize

#: The most series, and the most returns, that a block of the correlation is meant to hold: 12 bytes a return.
SYMBOLS_PER_BLOCK, VALUES_PER_BLOCK = 8192, 4_000_000
#: So many blocks at least, unless they would hold fewer series than this.
LEAST_BLOCKS, SYMBOLS_TO_SPREAD = 8, 64
#: Within a block, series are laid out so many at a time, in so many cells (symbols by days), at most.
SYMBOLS_PER_TILE, CELLS_PER_TILE = 512, 2**21


def chart_line(bars: DataFrame, points: int = 50) -> DataFrame:
    """Each symbol's series thinned to at most ``points`` buckets of consecutive bars."""
    return (
        bars.withColumn("bucket", F.ntile(points).over(by_day()))
        .groupBy("symbol", "bucket")
        .agg(
            F.min("trade_date").alias("from_date"),
            F.max("trade_date").alias("to_date"),
            to_price(F.min_by("close_c", "trade_date")).alias("first_close"),
            to_price(F.min("close_c")).alias("min_close"),
            to_price(F.max("close_c")).alias("max_close"),
            to_price(F.max_by("close_c", "trade_date")).alias("last_close"),
        )
    )


def chart_histogram(bars: DataFrame, low_c: int, high_c: int, bins: int) -> DataFrame:
    """Count of closes per symbol in equal bins of [low, high); bin 0 is below, bins+1 above."""
    place = F.width_bucket(
        F.col("close_c").cast("double"),
        F.lit(float(low_c)),
        F.lit(float(high_c)),
        F.lit(bins).cast("bigint"),
    )
    return (
        bars.groupBy("symbol", place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(
            "bin_low", F.when(F.col("bin") > 0, low_c + (F.col("bin") - 1) * (high_c - low_c) / bins)
        )
    )


def _span(rows: DataFrame, *values: str) -> DataFrame:
    """Least and greatest of whole-number columns per symbol."""
    ends = [f(name).alias(f"{label}_{name}") for name in values for f, label in ((F.min, "least"), (F.max, "most"))]
    return rows.groupBy("symbol").agg(*ends)


def _bins(value: str, bins: int):
    """How many bins a symbol has: no more than there are whole numbers between its least and greatest value."""
    return F.least(F.lit(bins).cast("bigint"), F.col(f"most_{value}") - F.col(f"least_{value}") + 1)


def _bin(value: str, bins: int):
    """The bin of a value, from 0; whole numbers, so none falls beside its bin."""
    width = F.col(f"most_{value}") - F.col(f"least_{value}") + 1
    return F.floor(((F.col(value) - F.col(f"least_{value}")) * _bins(value, bins)) / width).cast("int")


def chart_density(rows: DataFrame, value: str, points: int = 64, bins: int = 256) -> DataFrame:
    """A smooth density of a whole-number column per symbol: (symbol, at, density) at ``points`` places from least to greatest.

    Values are counted in ``bins``, and the counts smoothed by a normal kernel: what is
    summed per symbol is bins by points, however many rows there are. The bandwidth is
    1.06 deviations over the fifth root of the count, from exact moments. A symbol with a single value has none.
    """
    known = rows.where(F.col(value).isNotNull()).select("symbol", value)
    measured = known.groupBy("symbol").agg(
        F.min(value).alias(f"least_{value}"),
        F.max(value).alias(f"most_{value}"),
        F.count(F.lit(1)).alias("n"),
        F.sum(exact(F.col(value))).alias("total"),
        F.sum(square(F.col(value))).alias("squares"),
    )
    spread = sd_price(F.col("n"), F.col("total"), F.col("squares")) * 100
    measured = measured.withColumn("width", F.lit(1.06) * spread * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    measured = measured.where(F.col(f"least_{value}") < F.col(f"most_{value}")).select(
        "symbol", f"least_{value}", f"most_{value}", "n", "width"
    )
    counted = known.join(measured, "symbol").groupBy("symbol", _bin(value, bins).alias("bin")).agg(F.count(F.lit(1)).alias("held"))
    placed = counted.join(measured, "symbol").withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    least, reach = F.col(f"least_{value}").cast("double"), (F.col(f"most_{value}") - F.col(f"least_{value}")).cast("double")
    at = least + F.col("point") * reach / (points - 1)
    middle = least + (F.col("bin") + 0.5) * (reach + 1) / _bins(value, bins) - 0.5
    off = (at - middle) / F.col("width")
    return placed.groupBy("symbol", "point", at.alias("at"), "n", "width").agg(
        F.sum(F.col("held") * F.exp(-0.5 * off * off)).alias("sum")
    ).select("symbol", "at", (F.col("sum") / (F.col("n") * F.col("width") * math.sqrt(2 * math.pi))).alias("density"))


def chart_bins_2d(rows: DataFrame, x: str, y: str, bins: int = 16) -> DataFrame:
    """How often two whole-number columns occur together, per symbol, in up to ``bins`` by ``bins`` between their ends."""
    known = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select("symbol", x, y)
    placed = known.join(_span(known, x, y), "symbol")
    return placed.groupBy("symbol", _bin(x, bins).alias("x_bin"), _bin(y, bins).alias("y_bin")).agg(F.count(F.lit(1)).alias("n"))


def chart_box(rows: DataFrame, value: str, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at ``whisker`` x IQR and outlier count of a column, per symbol.

    Quartiles are put beside each row by a window and the rows then aggregated
    in the same partitioning: one shuffle, no join back.
    """
    q = F.percentile(value, [0.25, 0.5, 0.75]).over(whole_symbol())
    fenced = (
        rows.where(F.col(value).isNotNull())
        .select("symbol", F.col(value).alias("v"), q.alias("q"))
        .withColumn("reach", whisker * (F.col("q")[2] - F.col("q")[0]))
        .withColumn(
            "inside",
            (F.col("v") >= F.col("q")[0] - F.col("reach"))
            & (F.col("v") <= F.col("q")[2] + F.col("reach")),
        )
    )
    inside = F.when(F.col("inside"), F.col("v"))
    return fenced.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.first(F.col("q")[i]).alias(f"q{i + 1}") for i in range(3)],
        F.min(inside).alias("whisker_low"),
        F.max(inside).alias("whisker_high"),
        F.count(F.when(~F.col("inside"), 1)).alias("n_outliers"),
    )


_PAIRS = "symbol_a string, symbol_b string, n bigint, correlation double"


def _block_correlator(min_days: int):
    """The Arrow function for one pair of symbol blocks.

    It holds the series of both as they came, and lays them out over the days a tile of symbols
    at a time: the more days, the fewer symbols, so a tile and the pairs made of two have
    a bounded size.

    Made here so that it is sent to the executors by value: they need numpy and
    pyarrow, not this package.
    """
    most_symbols, most_cells = SYMBOLS_PER_TILE, CELLS_PER_TILE

    def correlate(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_block, right_block = (k.as_py() for k in key)
        rows = pa.Table.from_batches(list(batches))
        rows = rows.take(pc.sort_indices(rows["symbol"])).combine_chunks()
        symbols, block = rows["symbol"].combine_chunks(), rows["block"].to_numpy()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(rows["days"]).to_numpy())])
        dates, at = np.unique(pc.list_flatten(rows["days"]).to_numpy(), return_inverse=True)
        at = at.astype("int32")
        rets = pc.list_flatten(rows["rets"]).to_numpy().copy()
        for begin, end in zip(ends[:-1], ends[1:]):
            rets[begin:end] -= np.mean(rets[begin:end])
        tile = max(1, min(most_symbols, most_cells // len(dates)))

        def tiles(of: int) -> list[np.ndarray]:
            own = np.flatnonzero(block == of)
            return [own[i : i + tile] for i in range(0, len(own), tile)]

        def grid(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Returns centred per symbol, and a 0/1 presence mask, both symbols x days."""
            values = np.zeros((len(own), len(dates)))
            present = np.zeros_like(values)
            for i, k in enumerate(own):
                days = at[ends[k] : ends[k + 1]]
                values[i, days] = rets[ends[k] : ends[k + 1]]
                present[i, days] = 1.0
            return values, present

        lefts, rights = tiles(left_block), tiles(right_block)
        for p, left in enumerate(lefts):
            x, in_x = grid(left)
            squares_x = x**2
            for q, right in enumerate(rights):
                same = left_block == right_block and p == q
                if left_block == right_block and q < p:
                    continue
                y, in_y = (x, in_x) if same else grid(right)
                n = in_x @ in_y.T
                with np.errstate(divide="ignore", invalid="ignore"):
                    mean_x, mean_y = (x @ in_y.T) / n, (in_x @ y.T) / n
                    cov = (x @ y.T) / n - mean_x * mean_y
                    var_x = (squares_x @ in_y.T) / n - mean_x**2
                    var_y = (in_x @ (y**2).T) / n - mean_y**2
                    corr = cov / np.sqrt(var_x * var_y)
                    # A variance that rounding could have made: look at the shared days themselves.
                    noise = (var_x <= 1e-9 * (var_x + mean_x**2)) | (var_y <= 1e-9 * (var_y + mean_y**2))
                wanted = n > 0
                if same:
                    wanted &= np.triu(np.ones_like(wanted), k=1)
                for a, b in zip(*np.nonzero(noise & wanted & (n >= min_days))):
                    shared = (in_x[a] > 0) & (in_y[b] > 0)
                    own_x, own_y = x[a, shared], y[b, shared]
                    flat = np.ptp(own_x) == 0 or np.ptp(own_y) == 0
                    corr[a, b] = np.nan if flat else np.corrcoef(own_x, own_y)[0, 1]
                corr[n < min_days] = np.nan
                i, j = np.nonzero(wanted)
                a, b = left[i], right[j]  # places in the order of the symbols
                yield pa.RecordBatch.from_arrays(
                    [
                        symbols.take(pa.array(np.minimum(a, b))),
                        symbols.take(pa.array(np.maximum(a, b))),
                        pa.array(n[i, j].astype("int64")),
                        pa.array(corr[i, j]),
                    ],
                    ["symbol_a", "symbol_b", "n", "correlation"],
                )

    return correlate


def _blocks(symbols: int, values: int, symbols_per_block: int) -> int:
    """How many blocks: few, as a series is copied once for each, but enough that the pairs of blocks keep a cluster busy."""
    spread = min(LEAST_BLOCKS, -(-symbols // SYMBOLS_TO_SPREAD))
    return max(1, spread, -(-symbols // symbols_per_block), -(-values // VALUES_PER_BLOCK))


def chart_correlation(
    bars: DataFrame,
    min_days: int = 3,
    symbols_per_block: int = SYMBOLS_PER_BLOCK,
    chosen: DataFrame | None = None,
) -> DataFrame:
    """Correlation of daily returns for every pair of symbols sharing a day, with their number ``n``.

    It is null for pairs that share fewer than ``min_days``. Bars without a symbol are in no pair.

    The result grows with the square of the symbols: of very
    many, pass the ``chosen`` ones (column ``symbol``), and the others drop out first.

    A blocked matrix product. A self-join on the date would emit every pair of
    symbols once per day; here a symbol's series is one row, copied once per
    block of symbols, and a task sees the series of two blocks only. There are ``LEAST_BLOCKS`` blocks
    until one would hold more than ``symbols_per_block`` series or ``VALUES_PER_BLOCK`` returns; up to there
    the copies grow with the input, and beyond it they are few beside the pairs they
    yield. The series are written to the shared folder
    first, so that counting symbols does not repeat the work above.
    """
    if chosen is not None:
        bars = bars.join(chosen.select("symbol"), "symbol", "left_semi")
    returns = daily_return(bars).where(F.col("ret").isNotNull() & F.col("symbol").isNotNull())
    series = materialize(
        returns.groupBy("symbol")
        .agg(F.sort_array(F.collect_list(F.struct("trade_date", "ret"))).alias("s"))
        .select(
            "symbol",
            F.transform("s", lambda p: F.unix_date(p["trade_date"])).alias("days"),
            F.transform("s", lambda p: p["ret"]).alias("rets"),
        ),
        "return_series",
    )
    held = series.agg(F.count(F.lit(1)).alias("symbols"), F.sum(F.size("days")).alias("values")).first()
    blocks = _blocks(held["symbols"], held["values"] or 0, symbols_per_block)
    mine = F.pmod(F.xxhash64("symbol"), F.lit(blocks)).cast("int")
    placed = series.withColumn("block", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    pairs = placed.groupBy(
        F.least("block", "other").alias("left_block"), F.greatest("block", "other").alias("right_block")
    ).applyInArrow(_block_correlator(min_days), _PAIRS)
    return pairs.withColumn(
        "correlation",
        F.when(~F.isnan("correlation"), F.round("correlation", 9)),
    )
