"""Features, models, predictions and scores."""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import round_columns
from barloom.operators import forecast as fc
from barloom.plans.registry import query
from barloom.plans.sql import (
    BARS, FEATURES, MODEL, OLS, SPLIT, SUPPLIER_BARS, metrics,
)
from barloom.sources.scratch import materialize, new_path
from barloom.sources.tables import order_bars, supplier_bars

CUT = datetime.date(2000, 1, 1)


def _split_rows(spark, sf_dir) -> DataFrame:
    return fc.chrono_split(fc.features(order_bars(spark, sf_dir)), CUT)


def _model_input(spark, sf_dir) -> DataFrame:
    """Split features, written once: fitting reads them several times, predicting again."""
    return materialize(_split_rows(spark, sf_dir), "features")


def _rounded_metrics(scores: DataFrame) -> DataFrame:
    scores = round_columns(scores, 4, "rmse", "mae")
    scores = round_columns(scores, 0, "mse", "explained_variance")
    return round_columns(scores, 8, "r2")


@query("features", f"with {BARS}, {FEATURES} select * from features")
def features(spark, sf_dir):
    return fc.features(order_bars(spark, sf_dir))


@query("chrono_split", f"with {BARS}, {FEATURES}, {SPLIT} select symbol, trade_date, label_date, split from split_rows")
def chrono_split(spark, sf_dir):
    return _split_rows(spark, sf_dir).select("symbol", "trade_date", "label_date", "split")


@query(
    "assemble",
    f"""with {BARS}, {FEATURES}
      select symbol, trade_date, x1 as v_x1, x2 as v_x2, x_mean5 as v_x_mean5
      from features where x2 is not null""",
)
def assemble(spark, sf_dir):
    columns = ["x1", "x2", "x_mean5"]
    rows = fc.complete(fc.features(order_bars(spark, sf_dir)), columns)
    return fc.vector_columns(fc.assemble(rows, columns), columns).select(
        "symbol", "trade_date", *[f"v_{name}" for name in columns]
    )


@query(
    "fit_ols",
    f"""with {BARS}, {FEATURES}, {SPLIT}, {OLS}
      select 'intercept' as term, round(my - b1 * m1 - b2 * m2, 3) as value from ols
      union all select 'x1', round(b1, 6) from ols
      union all select 'x2', round(b2, 6) from ols""",
)
def fit_ols(spark, sf_dir):
    model = fc.fit_ols(fc.train_rows(_model_input(spark, sf_dir)))
    places = F.when(F.col("term") == "intercept", F.round("value", 3)).otherwise(F.round("value", 6))
    return fc.coefficients(spark, model).withColumn("value", places)


# Label and features of the training rows, centred and in standard deviations.
_SCALED = f"""{BARS}, {FEATURES}, {SPLIT},
  train as (select * from split_rows where split = 'train' and x2 is not null),
  scale as (
    select round(avg(label), 9) as my, round(stddev_samp(label), 9) as sy, round(avg(x1), 9) as m1,
           round(stddev_samp(x1), 9) as s1, round(avg(x2), 9) as m2, round(stddev_samp(x2), 9) as s2
    from train),
  z as (select symbol, trade_date, (label - my) / sy as y, (x1 - m1) / s1 as a, (x2 - m2) / s2 as b from train, scale)
"""


def _terms(spark, fit: fc.LinearFit) -> DataFrame:
    rows = [(name, fit.std_weights[name], fit.coefficients[name]) for name in fc.FEATURES]
    return round_columns(
        spark.createDataFrame(rows, "term string, std_weight double, value double"), 6, "std_weight", "value"
    )


@query(
    "fit_sgd",
    f"""with recursive {_SCALED},
      dealt as (select *, cast('0x' || substr(md5('0|' || symbol || '|' || cast(trade_date as varchar)), 1, 8) as bigint) % 16 as batch
                from z),
      steps as (
        select batch, row_number() over (order by epoch, md5('0|' || epoch || '|' || batch)) as t
        from (select distinct batch from dealt), (select unnest([0, 1]) as epoch)),
      sgd as (
        select cast(0 as bigint) as t, cast(0 as double) as u, cast(0 as double) as v
        union all
        select t, u - 0.5 / sqrt(t) * du, v - 0.5 / sqrt(t) * dv
        from (select steps.t, any_value(u) as u, any_value(v) as v,
                     avg((u * a + v * b - y) * a) as du, avg((u * a + v * b - y) * b) as dv
              from sgd join steps on steps.t = sgd.t + 1 join dealt on dealt.batch = steps.batch
              group by steps.t)),
      last as (select * from sgd order by t desc limit 1)
      select 'x1' as term, round(u, 6) + 0.0 as std_weight, round(u * sy / s1, 6) + 0.0 as value from last, scale
      union all select 'x2', round(v, 6) + 0.0, round(v * sy / s2, 6) + 0.0 from last, scale""",
)
def fit_sgd(spark, sf_dir):
    """Two epochs of 16 mini-batches: the path itself is compared, not what it tends to."""
    return _terms(spark, fc.fit_sgd(fc.train_rows(_model_input(spark, sf_dir))))


@query(
    "fit_huber",
    f"""with recursive {_SCALED},
      huber as (
        select 0 as t, cast(0 as double) as c, cast(0 as double) as u, cast(0 as double) as v, cast('inf' as double) as s
        union all
        select t + 1,
          (hy * (haa * hbb - hab * hab) - ha * (hay * hbb - hab * hby) + hb * (hay * hab - haa * hby)) / d,
          (h * (hay * hbb - hab * hby) - hy * (ha * hbb - hab * hb) + hb * (ha * hby - hay * hb)) / d,
          (h * (haa * hby - hay * hab) - ha * (ha * hby - hay * hb) + hy * (ha * hab - haa * hb)) / d,
          sqrt(squares / n / case when s = 'inf' then 1 else 0.7125606620913435 end)
        from (
          select *, h * (haa * hbb - hab * hab) - ha * (ha * hbb - hab * hb) + hb * (ha * hab - haa * hb) as d
          from (
            select t, any_value(s) as s, count(*) as n, sum(case when abs(e) > 1.35 * s then 1.35 * s * 1.35 * s else e * e end) as squares,
              sum(w) as h, sum(w * a) as ha, sum(w * b) as hb, sum(w * a * a) as haa, sum(w * a * b) as hab, sum(w * b * b) as hbb,
              sum(w * y) as hy, sum(w * a * y) as hay, sum(w * b * y) as hby
            from (select *, case when abs(e) > 1.35 * s then 1.35 * s / abs(e) else 1 end as w
                  from (select huber.*, a, b, y, y - (c + u * a + v * b) as e from huber, z where t < 60))
            group by t))),
      last as (select * from huber order by t desc limit 1)
      select 'x1' as term, round(u, 6) + 0.0 as std_weight, round(u * sy / s1, 6) + 0.0 as value from last, scale
      union all select 'x2', round(v, 6) + 0.0, round(v * sy / s2, 6) + 0.0 from last, scale""",
)
def fit_huber(spark, sf_dir):
    return _terms(spark, fc.fit_huber(fc.train_rows(_model_input(spark, sf_dir))))


def _correlations(prefix: str) -> str:
    """Means, deviations and covariances from sums n, sy ... sbb."""
    names = {"y": "sy", "a": "sa", "b": "sb"}
    parts = [f"{total} / n as {prefix}m{x}" for x, total in names.items()]
    for pair in ("yy", "ya", "yb", "aa", "ab", "bb"):
        parts.append(f"s{pair} / n - ({names[pair[0]]} / n) * ({names[pair[1]]} / n) as {prefix}c{pair}")
    return ", ".join(parts)


_SUMS = ["n", "sy", "sa", "sb", "syy", "sya", "syb", "saa", "sab", "sbb"]


@query(
    "fit_elastic_net",
    f"""with recursive {BARS}, {FEATURES}, {SPLIT},
      folds as (
        select year(label_date) as fold, cast(count(*) as double) as n, sum(label) as sy, sum(x1) as sa, sum(x2) as sb,
          sum(label * label) as syy, sum(label * x1) as sya, sum(label * x2) as syb,
          sum(x1 * x1) as saa, sum(x1 * x2) as sab, sum(x2 * x2) as sbb
        from split_rows where split = 'train' and x2 is not null group by 1),
      before as (
        select fold, {", ".join(f"sum({x}) over w as {x}" for x in _SUMS)}
        from folds window w as (order by fold rows between unbounded preceding and 1 preceding)
        union all
        select null, {", ".join(f"sum({x})" for x in _SUMS)} from folds),
      tasks as (
        select fold, penalty, {_correlations("")}
        from before, (select unnest([0.0, 0.01, 0.1, 0.3]::double[]) as penalty) where n is not null),
      scaled as (
        select *, cya / sqrt(cyy * caa) as ra, cyb / sqrt(cyy * cbb) as rb, cab / sqrt(caa * cbb) as rab from tasks),
      net as (
        select fold, penalty, 0 as t, cast(0 as double) as u, cast(0 as double) as v from scaled
        union all
        select fold, penalty, t + 1, u, sign(pull) * greatest(abs(pull) - penalty / 2, 0) / (1 + penalty / 2)
        from (
          select fold, penalty, t, u, rb - rab * u as pull
          from (
            select net.fold, net.penalty, t, rb, rab,
              sign(ra - rab * v) * greatest(abs(ra - rab * v) - net.penalty / 2, 0) / (1 + net.penalty / 2) as u
            from net join scaled on net.fold is not distinct from scaled.fold and net.penalty = scaled.penalty
            where t < 100))),
      fits as (
        select s.*, u, v, u * sqrt(cyy / caa) as ba, v * sqrt(cyy / cbb) as bb
        from scaled s join net on net.fold is not distinct from s.fold and net.penalty = s.penalty where t = 100),
      ahead as (
        select penalty, sum(n * (fcyy - 2 * (ba * fcya + bb * fcyb) + ba * ba * fcaa + 2 * ba * bb * fcab + bb * bb * fcbb
            + (fmy - (my - ba * ma - bb * mb) - ba * fma - bb * fmb) ** 2)) / sum(n) as mse
        from fits join (select fold, n, {_correlations("f")} from folds) f using (fold) group by penalty)
      select penalty, term, round(w, 6) + 0.0 as std_weight, round(slope, 6) + 0.0 as value, round(mse, 0) as mse_ahead,
        penalty = (select max(penalty) from ahead where mse = (select min(mse) from ahead)) as chosen
      from (select penalty, 'x1' as term, u as w, ba as slope from fits where fold is null
            union all select penalty, 'x2', v, bb from fits where fold is null) join ahead using (penalty)""",
)
def fit_elastic_net(spark, sf_dir):
    """The fits along the penalties, with their error on the years ahead."""
    net = fc.fit_elastic_net(fc.train_rows(_model_input(spark, sf_dir)))
    rows = [
        (penalty, name, fit.std_weights[name], fit.coefficients[name], mse, penalty == net.chosen)
        for penalty, fit, mse in net.path
        for name in fc.FEATURES
    ]
    shown = spark.createDataFrame(
        rows, "penalty double, term string, std_weight double, value double, mse_ahead double, chosen boolean"
    )
    return round_columns(round_columns(shown, 6, "std_weight", "value"), 0, "mse_ahead")


# Predictions are compared to the cent: solvers agree to about 1e-8 only.
_PREDICTIONS = f"""with {MODEL}
  select symbol, trade_date, split, label, round(prediction, 2) as prediction from predicted"""


@query("predict_close", _PREDICTIONS)
def predict_close(spark, sf_dir):
    rows = _model_input(spark, sf_dir)
    model = fc.fit_ols(fc.train_rows(rows))
    return round_columns(fc.predict_close(model, rows), 2, "prediction")


@query("model_store", _PREDICTIONS)
def model_store(spark, sf_dir):
    """``predict_close`` with a model that was saved and loaded again."""
    rows = _model_input(spark, sf_dir)
    path = new_path(spark, "model")
    fc.save_model(fc.fit_ols(fc.train_rows(rows)), path)
    return round_columns(fc.predict_close(fc.load_model(path), rows), 2, "prediction")


@query("evaluate", f"with {MODEL} {metrics('predicted')}")
def evaluate(spark, sf_dir):
    rows = _model_input(spark, sf_dir)
    model = fc.fit_ols(fc.train_rows(rows))
    return _rounded_metrics(fc.evaluate(fc.predict_close(model, rows)))


@query(
    "evaluate_pooled",
    f"""with {MODEL}, m as ({metrics('predicted')})
      select 'rmse' as metric, rmse as value from m where pooled
      union all select 'mse', mse from m where pooled
      union all select 'mae', mae from m where pooled
      union all select 'r2', r2 from m where pooled
      union all select 'var', explained_variance from m where pooled""",
)
def evaluate_pooled(spark, sf_dir):
    """The pooled metrics, a row each, in one pass over the predictions."""
    rows = _model_input(spark, sf_dir)
    model = fc.fit_ols(fc.train_rows(rows))
    pooled = fc.evaluate(fc.predict_close(model, rows)).where("pooled")
    pooled = pooled.withColumnRenamed("explained_variance", "var")
    scores = pooled.unpivot(["pooled"], ["rmse", "mse", "mae", "r2", "var"], "metric", "value").drop("pooled")
    name, value = F.col("metric"), F.col("value")
    rounded = (
        F.when(name.isin("mse", "var"), F.round(value, 0))
        .when(name == "r2", F.round(value, 8))
        .otherwise(F.round(value, 4))
    )
    return scores.withColumn("value", rounded)


@query(
    "naive_baseline",
    f"""with {BARS}, {FEATURES}, {SPLIT},
      naive as (select symbol, label, x1 as prediction from split_rows
                where split = 'test' and x2 is not null)
      {metrics('naive')}""",
)
def naive_baseline(spark, sf_dir):
    return _rounded_metrics(fc.evaluate(fc.naive_baseline(_split_rows(spark, sf_dir))))


@query(
    "per_symbol_ols",
    f"""with {SUPPLIER_BARS}, {FEATURES}
      select symbol, cast(regr_count(label, x1) as bigint) as n, round(regr_slope(label, x1), 8) + 0.0 as slope,
             round(regr_intercept(label, x1), 4) + 0.0 as intercept, round(regr_r2(label, x1), 8) + 0.0 as r2
      from features where label is not null and x1 is not null group by symbol""",
)
def per_symbol_ols(spark, sf_dir):
    fitted = fc.per_symbol_ols(fc.features(supplier_bars(spark, sf_dir)))
    return round_columns(round_columns(fitted, 8, "slope", "r2"), 4, "intercept")


@query(
    "walk_forward",
    f"""with {BARS},
      p as (select symbol, trade_date, close_c, lag(close_c) over d as x, lead(close_c) over d as next_c
            from bars window d as (partition by symbol order by trade_date)),
      s as (select *, count(x) over f as n, sum(cast(x as hugeint)) over f as sx,
              sum(case when x is not null then cast(close_c as hugeint) end) over f as sy,
              sum(cast(x as hugeint) * x) over f as sxx, sum(cast(x as hugeint) * close_c) over f as sxy
            from p window f as (partition by symbol order by trade_date
              rows between unbounded preceding and current row)),
      m as (select *, case when n >= 30 and n * sxx - sx * sx <> 0
              then cast(n * sxy - sx * sy as double) / cast(n * sxx - sx * sx as double) end as b from s)
      select symbol, trade_date, n, round(b, 9) + 0.0 as slope,
             round(((cast(sy as double) - b * cast(sx as double)) / nullif(n, 0) + b * close_c) / 100, 4)
               as prediction,
             cast(next_c as double) / 100 as label
      from m""",
)
def walk_forward(spark, sf_dir):
    walked = fc.walk_forward(order_bars(spark, sf_dir))
    return round_columns(round_columns(walked, 9, "slope"), 4, "prediction")
