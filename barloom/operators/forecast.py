"""Features, linear models of the next close, and their scores.

All symbols are pooled in one model unless the name says otherwise.
"""

from __future__ import annotations

import dataclasses
import datetime
import hashlib
import statistics
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.columns import exact, mean_price, square, to_price
from barloom.functions.windows import by_day, so_far, trailing
from barloom.schemas import KEY
from barloom.sources.scratch import new_path

FEATURES = ["x1", "x2"]


def features(bars: DataFrame) -> DataFrame:
    """Features known at a bar's close, and ``label``, the next close.

    ``x1`` close, ``x2`` previous close, ``x_lag2`` the one before, ``x_mean5``
    mean of the last five. The newest bar of a symbol has no label; it is the
    one to forecast from.
    """
    day = by_day()
    close = to_price(F.col("close_c"))
    return bars.select(
        "symbol",
        "trade_date",
        close.alias("x1"),
        to_price(F.lag("close_c", 1).over(day)).alias("x2"),
        to_price(F.lag("close_c", 2).over(day)).alias("x_lag2"),
        mean_price(F.col("close_c"), trailing(5)).alias("x_mean5"),
        to_price(F.lead("close_c").over(day)).alias("label"),
        F.lead("trade_date").over(day).alias("label_date"),
    )


def chrono_split(rows: DataFrame, cut: datetime.date) -> DataFrame:
    """Adds ``split``: train, test, forecast (no label yet) or purged.

    A row is in train only if its label too falls before the cut; the rows
    astride it are purged, or the model would have seen prices of the test period.
    """
    split = (
        F.when(F.col("label_date").isNull(), "forecast")
        .when(F.col("label_date") < F.lit(cut), "train")
        .when(F.col("trade_date") >= F.lit(cut), "test")
        .otherwise("purged")
    )
    return rows.withColumn("split", split)


def complete(rows: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Rows in which none of the feature columns is null."""
    return rows.dropna(subset=columns)


def train_rows(split_rows: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    return complete(split_rows.where(F.col("split") == "train"), columns)


def assemble(rows: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Adds the feature vector."""
    return VectorAssembler(inputCols=columns, outputCol="features").transform(rows)


def vector_columns(rows: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """The vector's entries as plain columns ``v_<name>``."""
    entries = vector_to_array("features")
    return rows.withColumns({f"v_{name}": entries[i] for i, name in enumerate(columns)})


def fit_ols(train: DataFrame, columns: list[str] = FEATURES) -> PipelineModel:
    """Least squares by the normal equations: a small matrix goes to the driver.

    Spark reads ``train`` a few times, so pass a written table where it is dear.
    """
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="features"),
            LinearRegression(featuresCol="features", labelCol="label", solver="normal"),
        ]
    ).fit(train)


def coefficients(spark: SparkSession, model: PipelineModel, columns: list[str] = FEATURES) -> DataFrame:
    """A fitted model as rows (term, value)."""
    fitted = model.stages[-1]
    rows = [("intercept", float(fitted.intercept))]
    rows += [(name, float(value)) for name, value in zip(columns, fitted.coefficients)]
    return spark.createDataFrame(rows, "term string, value double")


@dataclass(frozen=True)
class LinearFit:
    """A linear model in price units, with its weights in standard deviations beside."""

    intercept: float
    coefficients: dict[str, float]
    std_weights: dict[str, float]

    def predict(self, rows: DataFrame) -> DataFrame:
        """Adds ``prediction`` to the rows that have all features."""
        columns = list(self.coefficients)
        value = F.lit(self.intercept)
        for name in columns:
            value = value + F.lit(self.coefficients[name]) * F.col(name)
        return complete(rows, columns).withColumn("prediction", value)


def _linear_fit(columns: list[str], weights: list[float], scale: Scale) -> LinearFit:
    """Weights in standard deviations as a model in price units."""
    slopes = [weight * scale.label_sd / sd for weight, sd in zip(weights, scale.sds)]
    return LinearFit(
        intercept=scale.label_mean - sum(slope * mean for slope, mean in zip(slopes, scale.means)),
        coefficients=dict(zip(columns, slopes)),
        std_weights=dict(zip(columns, weights)),
    )


@dataclass(frozen=True)
class Scale:
    """Means and sample deviations of label and features, to 9 places, so that they don't hang on the partitioning."""

    label_mean: float
    label_sd: float
    means: list[float]
    sds: list[float]

    @classmethod
    def of(cls, train: DataFrame, columns: list[str]) -> Scale:
        names = ["label", *columns]
        measures = [F.round(f(name), 9) for name in names for f in (F.avg, F.stddev_samp)]
        row = list(train.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)]).first())
        return cls(row[0], row[1], row[2::2], row[3::2])

    def apply(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """``z_label`` and ``z_<name>``, centred and in standard deviations, beside the other columns."""
        scaled = {"z_label": (F.col("label") - F.lit(self.label_mean)) / F.lit(self.label_sd)}
        for name, mean, sd in zip(columns, self.means, self.sds):
            scaled[f"z_{name}"] = (F.col(name) - F.lit(mean)) / F.lit(sd)
        return rows.withColumns(scaled)


def batch_of(batches: int, seed: int, key: list[str]) -> Column:
    """The mini-batch of a row, by its key alone: the first 32 bits of an MD5, modulo ``batches``."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(name).cast("string") for name in key])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(batches)).cast("int")


def fit_sgd(
    train: DataFrame,
    columns: list[str] = FEATURES,
    batches: int = 16,
    epochs: int = 2,
    step: float = 0.5,
    seed: int = 0,
    key: list[str] = KEY,
) -> LinearFit:
    """Least squares by stochastic gradient descent on mini-batches of standardised label and features.

    Rows are dealt to ``batches`` by a seeded hash of their key, and stored so; each epoch goes through
    the batches in a seeded order. A step reads one batch and sums its gradient, partial sums on the map
    side and one row to the driver, then moves against the mean by ``step`` over the root of the
    step's number. Unscaled prices would make the descent diverge; with everything centred there is no intercept to fit.

    Gradients are summed in whole 10^-9ths, so the path is the same whatever the partitioning. A
    cluster reads each row once an epoch. What comes out is near the least squares of ``fit_ols``, not equal to it.
    """
    scale = Scale.of(train, columns)
    names = ["z_label", *[f"z_{name}" for name in columns]]
    dealt = scale.apply(train, columns).select(*names, batch_of(batches, seed, key).alias("batch"))
    path = new_path(train.sparkSession, "batches")
    dealt.hint("rebalance", "batch").write.partitionBy("batch").parquet(path)
    stored = train.sparkSession.read.schema(dealt.schema).parquet(path)
    held = {row["batch"] for row in stored.select("batch").distinct().collect()}
    weights, steps = [0.0] * len(columns), 0
    for epoch in range(epochs):
        for batch in sorted(held, key=lambda b: hashlib.md5(f"{seed}|{epoch}|{b}".encode()).hexdigest()):
            steps += 1
            error = -F.col("z_label")
            for name, weight in zip(columns, weights):
                error = error + F.lit(weight) * F.col(f"z_{name}")
            sums = [F.sum(F.round(error * F.col(f"z_{name}") * 1e9).cast("decimal(38,0)")) for name in columns]
            row = stored.where(F.col("batch") == batch).agg(F.count(F.lit(1)), *sums).first()
            weights = [w - step / steps**0.5 * (float(total) / 1e9 / row[0]) for w, total in zip(weights, row[1:])]
    return _linear_fit(columns, weights, scale)


def _products(rows: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """Count, sums and sums of products of label and features, per group."""
    names = ["label", *columns]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(name).alias(f"s_{name}") for name in names],
        *[F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in pairs],
    )


class _Moments:
    """Centred and scaled moments of label and features from sums; sums of several folds add up."""

    def __init__(self, rows: list, columns: list[str]):
        names = ["label", *columns]
        self.n = sum(row["n"] for row in rows)
        total = {name: sum(row[f"s_{name}"] for row in rows) for name in names}
        self.mean = {name: total[name] / self.n for name in names}
        self.cov = {}
        for i, a in enumerate(names):
            for b in names[i:]:
                product = sum(row[f"p_{a}_{b}"] for row in rows)
                self.cov[a, b] = self.cov[b, a] = product / self.n - self.mean[a] * self.mean[b]
        self.sd = {name: max(self.cov[name, name], 0.0) ** 0.5 for name in names}

    def squared_error(self, intercept: float, slopes: dict[str, float]) -> float:
        """The mean squared error of a linear model on these rows."""
        bias = self.mean["label"] - intercept - sum(b * self.mean[name] for name, b in slopes.items())
        spread = self.cov["label", "label"] - 2 * sum(b * self.cov[name, "label"] for name, b in slopes.items())
        spread += sum(b * c * self.cov[x, y] for x, b in slopes.items() for y, c in slopes.items())
        return spread + bias * bias


def _descend(m: _Moments, columns: list[str], penalty: float, mix: float, sweeps: int, tolerance: float) -> LinearFit:
    """Elastic net by coordinate descent on the correlations of label and features; a constant feature gets 0."""
    used = [name for name in columns if m.sd[name] > 0 and m.sd["label"] > 0]
    r = {(a, b): m.cov[a, b] / (m.sd[a] * m.sd[b]) for a in ["label", *used] for b in ["label", *used]}
    weight = dict.fromkeys(columns, 0.0)
    for _ in range(sweeps):
        moved = 0.0
        for a in used:
            pull = r[a, "label"] - sum(r[a, b] * weight[b] for b in used if b != a)
            shrunk = max(abs(pull) - penalty * mix, 0.0) * (1 if pull > 0 else -1)
            new = shrunk / (1 + penalty * (1 - mix))
            moved, weight[a] = max(moved, abs(new - weight[a])), new
        if moved < tolerance:
            break
    slopes = {name: weight[name] * m.sd["label"] / m.sd[name] if name in used else 0.0 for name in columns}
    intercept = m.mean["label"] - sum(slopes[name] * m.mean[name] for name in columns)
    return LinearFit(intercept=intercept, coefficients=slopes, std_weights=weight)


@dataclass(frozen=True)
class NetFit:
    """An elastic net: the fit at the chosen penalty, and per penalty tried its fit and mean squared error ahead."""

    chosen: float
    fit: LinearFit
    path: list[tuple[float, LinearFit, float]]


def fit_elastic_net(
    train: DataFrame,
    columns: list[str] = FEATURES,
    penalties: tuple[float, ...] = (0.0, 0.01, 0.1, 0.3),
    mix: float = 0.5,
    fold: Column | None = None,
    sweeps: int = 1_000,
    tolerance: float = 1e-12,
) -> NetFit:
    """Squared error with a penalty on standardised weights, ``mix`` of it absolute and the rest squared.

    The penalty is chosen by folds in order of time (``fold``, the year of the label's date unless given):
    each fold but the first is predicted by the fit on those before it, never on later ones. The
    least mean squared error over all these rows wins, of equal ones the largest penalty.

    One pass and one shuffle of partial sums over the rows: a fold is a row of sums of products, and the fits
    before each fold use sums of these. Coordinate descent runs on that small matrix, whose size
    does not depend on the rows; with features in the thousands it would be the driver's limit.
    """
    fold = F.year("label_date") if fold is None else fold
    rows = _products(train.withColumn("_fold", fold), columns, "_fold").collect()
    folds = sorted((row for row in rows if row["_fold"] is not None), key=lambda row: row["_fold"])
    if not folds:
        raise ValueError("no training rows")
    path = []
    for penalty in penalties:
        squares = seen = 0.0
        for k in range(1, len(folds)):
            fit = _descend(_Moments(folds[:k], columns), columns, penalty, mix, sweeps, tolerance)
            ahead = _Moments([folds[k]], columns)
            squares += ahead.n * ahead.squared_error(fit.intercept, fit.coefficients)
            seen += ahead.n
        whole = _descend(_Moments(folds, columns), columns, penalty, mix, sweeps, tolerance)
        path.append((penalty, whole, squares / seen if seen else float("nan")))
    chosen = min(path, key=lambda one: (round(one[2], 9) if one[2] == one[2] else 0.0, -one[0]))
    return NetFit(chosen[0], chosen[1], path)


def fit_huber(
    train: DataFrame, columns: list[str] = FEATURES, bound: float = 1.35, most: int = 60, tolerance: float = 1e-9
) -> LinearFit:
    """A linear model by Huber's loss: errors of over ``bound`` deviations count by size, not by square.

    Iteratively reweighted least squares. A round is one aggregate of weighted sums of products, solved on the driver,
    until no weight moves by ``tolerance`` or ``most`` rounds are over. The deviation is fitted along
    with the weights (Huber's second proposal): the one at which the squares of the errors, cut at the bound, have the
    mean they have in a normal distribution. It starts from all errors and shrinks as outliers are cut.
    """
    normal = statistics.NormalDist()
    beyond = 2 * (1 - normal.cdf(bound))
    expected = 1 - beyond - 2 * bound * normal.pdf(bound) + bound**2 * beyond
    scale = Scale.of(train, columns)
    z = scale.apply(train, columns)
    terms = [F.lit(1.0), *[F.col(f"z_{name}") for name in columns]]
    p = len(terms)
    fitted, deviation = [0.0] * p, float("inf")
    for _ in range(most):
        error = F.col("z_label")
        for value, term in zip(fitted, terms):
            error = error - F.lit(value) * term
        far = F.abs(error) > F.lit(bound * deviation)
        weight = F.when(far, F.lit(bound * deviation) / F.abs(error)).otherwise(1.0)
        cut = F.when(far, F.lit((bound * deviation) ** 2)).otherwise(error * error)
        sums = [F.sum(weight * terms[i] * terms[j]) for i in range(p) for j in range(i, p)]
        sums += [F.sum(weight * term * F.col("z_label")) for term in terms]
        n, squares, *row = z.agg(F.count(F.lit(1)), F.sum(cut), *sums).first()
        gram = np.zeros((p, p))
        gram[np.triu_indices(p)] = row[: len(row) - p]
        gram = gram + np.triu(gram, 1).T
        before, was = fitted, deviation
        fitted = np.linalg.lstsq(gram, np.array(row[-p:], dtype=float), rcond=None)[0].tolist()
        deviation = (squares / n / (1.0 if was == float("inf") else expected)) ** 0.5
        if max(abs(x - y) for x, y in zip([*fitted, deviation], [*before, was])) < tolerance or deviation == 0:
            break
    fit = _linear_fit(columns, fitted[1:], scale)
    return dataclasses.replace(fit, intercept=fit.intercept + fitted[0] * scale.label_sd)


def predict(model: PipelineModel, rows: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Adds ``prediction``, the forecast of the next close."""
    return model.transform(complete(rows, columns)).drop("features")


def predict_close(model: PipelineModel, split_rows: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Predictions for the test period, and one forecast per symbol from its newest bar.

    The newest bar of a symbol too young to have all features gets a null prediction.
    """
    shown = ["symbol", "trade_date", "split", "label", "prediction"]
    wanted = split_rows.where(F.col("split").isin("test", "forecast"))
    young = wanted.where(F.col("split") == "forecast").where(
        F.exists(F.array(*[F.col(name).isNull() for name in columns]), lambda missing: missing)
    )
    young = young.withColumn("prediction", F.lit(None).cast("double"))
    return predict(model, wanted, columns).select(shown).unionByName(young.select(shown))


def evaluate(predictions: DataFrame) -> DataFrame:
    """RMSE, MSE, MAE, R2 and explained variance per symbol, and once for all (``pooled``).

    One pass and one shuffle of partial sums for all of them.
    """
    y, p = F.col("label"), F.col("prediction")
    sse = F.sum((p - y) * (p - y))
    n = F.count(F.lit(1))
    scored = (
        predictions.where(y.isNotNull())
        .rollup("symbol")
        .agg(
            (F.grouping("symbol") == 1).alias("pooled"),
            n.alias("n"),
            (sse / n).alias("mse"),
            F.avg(F.abs(p - y)).alias("mae"),
            F.var_pop(y).alias("label_var"),
            F.var_pop(p).alias("prediction_var"),
            (F.avg(p) - F.avg(y)).alias("bias"),
        )
    )
    mse, label_var = F.col("mse"), F.col("label_var")
    return scored.select(
        "pooled",
        "symbol",
        "n",
        F.sqrt(mse).alias("rmse"),
        "mse",
        "mae",
        (1 - mse / F.nullif(label_var, F.lit(0.0))).alias("r2"),
        (F.col("prediction_var") + F.col("bias") * F.col("bias")).alias("explained_variance"),
    )


def score(predictions: DataFrame, metric: str = "rmse") -> float:
    """One pooled metric: rmse, mse, mae, r2 or var. Each call is a pass over the rows;
    for several of them use ``evaluate``."""
    return RegressionEvaluator(
        labelCol="label", predictionCol="prediction", metricName=metric
    ).evaluate(predictions.where(F.col("label").isNotNull()))


def naive_baseline(split_rows: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """The forecast any model has to beat: tomorrow's close is today's."""
    test = complete(split_rows.where(F.col("split") == "test"), columns)
    return test.withColumn("prediction", F.col("x1"))


def per_symbol_ols(rows: DataFrame, feature: str = "x1") -> DataFrame:
    """One single-feature model per symbol, all in one aggregate."""
    return (
        rows.where(F.col("label").isNotNull() & F.col(feature).isNotNull())
        .groupBy("symbol")
        .agg(
            F.regr_count("label", feature).alias("n"),
            F.regr_slope("label", feature).alias("slope"),
            F.regr_intercept("label", feature).alias("intercept"),
            F.regr_r2("label", feature).alias("r2"),
        )
    )


def walk_forward(bars: DataFrame, min_pairs: int = 30) -> DataFrame:
    """A model per symbol refitted at every bar on the bars so far, without a loop.

    The pair of bar t is (previous close, close), known at t. The model applied
    at t is fitted on the pairs up to t from running, exact integer sums, so no
    later price can enter it; it predicts the close after t.
    """
    day, past = by_day(), so_far()
    paired = bars.select(
        "symbol", "trade_date", "close_c", F.lag("close_c").over(day).alias("prev_c"),
        F.lead("close_c").over(day).alias("next_c"),
    )
    x = exact(F.col("prev_c"))
    y = F.when(x.isNotNull(), exact(F.col("close_c")))
    sums = paired.withColumns(
        {
            "n": F.count("prev_c").over(past),
            "sx": F.sum(x).over(past),
            "sy": F.sum(y).over(past),
            "sxx": F.sum(square(F.col("prev_c"))).over(past),
            "sxy": F.sum(exact(x * y)).over(past),
        }
    )
    n, sx, sy = F.col("n").cast("decimal(18,0)"), F.col("sx"), F.col("sy")
    across = (n * F.col("sxy") - sx * sy).cast("double")
    spread = (n * F.col("sxx") - sx * sx).cast("double")
    enough = (F.col("n") >= min_pairs) & (spread != 0)
    fitted = sums.withColumn("slope", F.when(enough, across / spread)).withColumn(
        "intercept_c",
        (sy.cast("double") - F.col("slope") * sx.cast("double")) / F.nullif(F.col("n"), F.lit(0)),
    )
    return fitted.select(
        "symbol",
        "trade_date",
        "n",
        "slope",
        ((F.col("intercept_c") + F.col("slope") * F.col("close_c")) / 100).alias("prediction"),
        to_price(F.col("next_c")).alias("label"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
