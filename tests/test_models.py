"""Fitted models against the closed form, their scores, and the store."""

import datetime
import hashlib
import random
import statistics

import numpy as np
import pytest

from barloom.operators import forecast as fc
from barloom.sources.tables import order_bars

SF = "/root/testdata/sf0.001"
CUT = datetime.date(2000, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    cached = fc.chrono_split(fc.features(order_bars(spark, SF)), CUT).cache()
    yield cached
    cached.unpersist()


@pytest.fixture(scope="module")
def model(rows):
    return fc.fit_ols(fc.train_rows(rows))


def test_ols_equals_closed_form(rows, model):
    train = fc.train_rows(rows).select("x1", "x2", "label").toPandas()
    design = np.column_stack([np.ones(len(train)), train[["x1", "x2"]]])
    want = np.linalg.lstsq(design, train["label"], rcond=None)[0]
    fitted = model.stages[-1]
    assert [fitted.intercept, *fitted.coefficients] == pytest.approx(list(want), rel=1e-6)


def test_sgd_approaches_ols(rows, model):
    train = fc.train_rows(rows)
    sd = train.select("x1", "x2", "label").toPandas().std()
    ols = model.stages[-1]
    want = {x: c * sd[x] / sd["label"] for x, c in zip(fc.FEATURES, ols.coefficients)}
    fit = fc.fit_sgd(train, epochs=6)
    assert fit.std_weights == pytest.approx(want, abs=0.03) and fit.std_weights != pytest.approx(want, abs=1e-9)
    assert fit.intercept == pytest.approx(ols.intercept, rel=0.03)
    assert fc.fit_sgd(train, epochs=6, seed=1).std_weights != fit.std_weights  # another path


def test_sgd_takes_the_same_path_whatever_the_partitioning(rows):
    train = fc.train_rows(rows)
    fits = [fc.fit_sgd(df, batches=4, epochs=2) for df in (train.coalesce(1), train.repartition(7, "x1"))]
    assert fits[0] == fits[1]


def test_sgd_equals_plain_steps(rows):
    train = fc.train_rows(rows).withColumn("batch", fc.batch_of(5, 3, ["symbol", "trade_date"])).toPandas()
    z = {c: ((train[c] - train[c].mean()) / train[c].std()).to_numpy() for c in ["label", *fc.FEATURES]}
    design, weights, t = np.column_stack([z[c] for c in fc.FEATURES]), np.zeros(2), 0
    for epoch in range(2):
        for batch in sorted(set(train["batch"]), key=lambda b: hashlib.md5(f"3|{epoch}|{b}".encode()).hexdigest()):
            own = (train["batch"] == batch).to_numpy()
            t += 1
            weights = weights - 0.5 / t**0.5 * design[own].T @ (design[own] @ weights - z["label"][own]) / own.sum()
    fit = fc.fit_sgd(fc.train_rows(rows), batches=5, epochs=2, seed=3)
    assert [fit.std_weights[c] for c in fc.FEATURES] == pytest.approx(list(weights), abs=1e-6)


def _frame(spark, n, slope, outliers=0):
    random.seed(61)
    found = []
    for i in range(n):
        x1, x2 = random.gauss(5, 2), random.gauss(-3, 1)
        label = 1 + slope * x1 + 0.5 * x2 + random.gauss(0, 0.3) + (500 if i < outliers else 0)
        found.append(("S", datetime.date(2000, 1, 1) + datetime.timedelta(days=i), x1, x2, 1.0, label, datetime.date(2000 + 4 * i // n, 1, 2)))
    return spark.createDataFrame(found, "symbol string, trade_date date, x1 double, x2 double, same double, label double, label_date date")


def _net_by_hand(data, columns, penalty, mix):
    """Coordinate descent on the rows themselves."""
    y = (data["label"] - data["label"].mean()).to_numpy() / data["label"].std(ddof=0)
    design = np.column_stack([(data[c] - data[c].mean()) / data[c].std(ddof=0) for c in columns])
    weights = np.zeros(len(columns))
    for _ in range(500):
        for j in range(len(columns)):
            pull = design[:, j] @ (y - design @ weights + design[:, j] * weights[j]) / len(y)
            weights[j] = np.sign(pull) * max(abs(pull) - penalty * mix, 0) / (1 + penalty * (1 - mix))
    return weights


def test_elastic_net_equals_descent_on_the_rows(spark):
    train = _frame(spark, 400, 0.7)
    data = train.toPandas()
    net = fc.fit_elastic_net(train, ["x1", "x2", "same"], (0.0, 0.05, 0.5, 2.0), mix=0.3)
    for penalty, fit, _ in net.path:
        want = _net_by_hand(data, ["x1", "x2"], penalty, 0.3)
        assert [fit.std_weights["x1"], fit.std_weights["x2"]] == pytest.approx(list(want), abs=1e-9)
        assert fit.coefficients["same"] == 0
    ols = np.linalg.lstsq(np.column_stack([np.ones(400), data[["x1", "x2"]]]), data["label"], rcond=None)[0]
    assert [net.path[0][1].intercept, *list(net.path[0][1].coefficients.values())[:2]] == pytest.approx(list(ols), rel=1e-8)


def test_penalties_are_judged_on_later_rows_only(spark):
    train = _frame(spark, 300, 0.7)
    data = train.toPandas()
    years = data["label_date"].map(lambda d: d.year)
    net = fc.fit_elastic_net(train, ["x1", "x2"], (0.0, 0.2))
    for penalty, _, error in net.path:
        squares = []
        for year in sorted(set(years))[1:]:
            past, ahead = data[years < year], data[years == year]
            weights = _net_by_hand(past, ["x1", "x2"], penalty, 0.5)
            slopes = [w * past["label"].std(ddof=0) / past[c].std(ddof=0) for w, c in zip(weights, ["x1", "x2"])]
            guess = past["label"].mean() + sum(s * (ahead[c] - past[c].mean()) for s, c in zip(slopes, ["x1", "x2"]))
            squares += list((guess - ahead["label"]) ** 2)
        assert error == pytest.approx(np.mean(squares), rel=1e-8)
    assert net.chosen == min(net.path, key=lambda one: one[2])[0]
    with pytest.raises(ValueError):
        fc.fit_elastic_net(train.limit(0))


def test_huber_leaves_planted_outliers_aside(spark):
    train = _frame(spark, 500, 0.7, outliers=40)
    fit = fc.fit_huber(train)
    assert fit.coefficients == pytest.approx({"x1": 0.7, "x2": 0.5}, abs=0.05) and fit.intercept == pytest.approx(1, abs=0.4)
    data = train.toPandas()
    ols = np.linalg.lstsq(np.column_stack([np.ones(500), data[["x1", "x2"]]]), data["label"], rcond=None)[0]
    assert abs(ols[0] - 1) > 10
    # At the fit, no error beyond the bound pulls more than one at the bound.
    error = (data["label"] - fit.intercept - sum(fit.coefficients[c] * data[c] for c in fc.FEATURES)).to_numpy()
    normal = statistics.NormalDist()
    beyond = 2 * (1 - normal.cdf(1.35))
    expected = 1 - beyond - 2 * 1.35 * normal.pdf(1.35) + 1.35**2 * beyond
    low, high = 1e-9, 1e4
    for _ in range(200):
        sigma = (low + high) / 2
        low, high = (sigma, high) if np.minimum(error**2, (1.35 * sigma) ** 2).mean() > expected * sigma**2 else (low, sigma)
    pull = np.clip(error, -1.35 * sigma, 1.35 * sigma)
    for values in (np.ones(500), data["x1"], data["x2"]):
        assert abs((pull * values).mean()) < 1e-4


def test_more_features(rows):
    columns = ["x1", "x2", "x_lag2", "x_mean5"]
    model = fc.fit_ols(fc.train_rows(rows, columns), columns)
    assert fc.predict_close(model, rows, columns).where("prediction is null").count() == 0


def test_every_symbol_has_one_forecast(rows, model):
    forecasts = fc.predict_close(model, rows).where("split = 'forecast'").collect()
    assert len({r.symbol for r in forecasts}) == len(forecasts) == 5
    assert all(r.label is None and r.prediction is not None for r in forecasts)


def test_evaluate_equals_the_evaluator(rows, model):
    predictions = fc.predict_close(model, rows).cache()
    scores = {r.symbol: r for r in fc.evaluate(predictions).collect()}
    assert [s for s, r in scores.items() if r.pooled] == [None]
    assert scores[None].n == predictions.where("split = 'test'").count()
    for symbol, row in scores.items():
        part = predictions if row.pooled else predictions.where(predictions.symbol == symbol)
        for metric, column in [
            ("rmse", "rmse"), ("mse", "mse"), ("mae", "mae"), ("r2", "r2"), ("var", "explained_variance"),
        ]:
            # The evaluator takes the variance around the label mean, as we do.
            assert row[column] == pytest.approx(fc.score(part, metric), rel=1e-9, abs=1e-9), (symbol, metric)


def test_baseline_predicts_todays_close(rows):
    got = fc.naive_baseline(rows)
    assert got.where("prediction <> x1").count() == 0
    assert got.where("split <> 'test'").count() == 0


def test_reloaded_model_predicts_the_same(rows, model, tmp_path):
    path = str(tmp_path / "model")
    fc.save_model(model, path)
    fc.save_model(model, path)
    key = ["symbol", "trade_date"]
    a = fc.predict_close(model, rows).orderBy(*key).collect()
    assert a == fc.predict_close(fc.load_model(path), rows).orderBy(*key).collect()


def test_per_symbol_models(rows):
    data = fc.complete(rows, ["x1", "label"]).select("symbol", "x1", "label").toPandas()
    for row in fc.per_symbol_ols(rows).collect():
        part = data[data["symbol"] == row.symbol]
        slope, intercept = np.polyfit(part["x1"], part["label"], 1)
        assert (row.n, row.slope, row.intercept) == (
            len(part), pytest.approx(slope, rel=1e-6), pytest.approx(intercept, rel=1e-6),
        )
