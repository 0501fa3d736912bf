"""Model operators: quality on a planted signal, determinism, identities."""
import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helioframe.models.adaboost import AdaBoostR2, AdaBoostR2Model
from helioframe.models.bagging import BaggingRegressor
from helioframe.models.base import add_prediction, pipeline
from helioframe.models.search import expand_grid, randint, sample_candidates
from helioframe.models.simple import (fit_linear, fit_pca, forest_params, load_model,
                                      pca_columns, random_forest, save_model, tree_depth)
from helioframe.models.svr import EpsilonSVR
from helioframe.models.trees import Tree
from helioframe.operators.metrics import regression_metrics
from helioframe.plans.training_job import SearchConfig, train_all

FEATS = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        x1, x2, x3 = rng.uniform(-2, 2), rng.uniform(-2, 2), rng.uniform(-2, 2)
        y = math.sin(2 * x1) + 0.5 * x2 * x2 + 0.1 * x3 + rng.gauss(0, 0.05)
        rows.append((i, x1, x2, x3, y))
    return spark.createDataFrame(rows, "id int, x1 double, x2 double, x3 double, y double").cache()


def _rmse(df, col):
    return regression_metrics(df, "y", {"m": col}).first().rmse


def _baseline(planted):
    return _rmse(planted.withColumn("m", F.lit(planted.agg(F.avg("y")).first()[0])), "m")


@pytest.mark.parametrize("make", [
    lambda: random_forest("y", n_estimators=20, max_depth=8, max_features="auto", seed=1),
    lambda: AdaBoostR2(labelCol="y", nEstimators=6, learningRate=1.0, maxDepth=3, seed=0),
    lambda: BaggingRegressor(labelCol="y", nEstimators=8, baseMaxDepth=8, seed=42),
    lambda: BaggingRegressor(labelCol="y", nEstimators=4, maxFeatures=0.67, maxSamples=0.8,
                             bootstrapFeatures=False, baseMaxDepth=8, seed=42),
    lambda: EpsilonSVR(labelCol="y", kernel="rbf", C=10.0, epsilon=0.05, nComponents=60,
                       maxIter=60, seed=0),
])
def test_nonlinear_models_beat_the_mean(spark, planted, make):
    model = pipeline(FEATS, make()).fit(planted)
    pred = add_prediction(model, planted, "p")
    assert _rmse(pred, "p") < 0.8 * _baseline(planted)


def test_polynomial_kernel_fits_a_homogeneous_cubic(spark, planted):
    cubic = planted.withColumn("y", F.expr("x1 * x1 * x1 - 2 * x1 * x2 * x3 + 0.5 * x2 * x2 * x1"))
    model = pipeline(FEATS, EpsilonSVR(labelCol="y", kernel="poly", C=100.0, epsilon=0.01)).fit(cubic)
    assert _rmse(add_prediction(model, cubic, "p"), "p") < 0.05 * _baseline(cubic)


def test_linear_svr_close_to_ols_on_linear_data(spark):
    rng = random.Random(3)
    rows = [(x, 2 * x + 1 + rng.gauss(0, 0.01)) for x in (rng.uniform(0, 1) for _ in range(400))]
    df = spark.createDataFrame(rows, "x1 double, y double")
    m = pipeline(["x1"], EpsilonSVR(labelCol="y", kernel="linear", C=100.0, epsilon=0.01,
                                    maxIter=150)).fit(df)
    assert _rmse(add_prediction(m, df, "p"), "p") < 0.1


def test_ols_matches_closed_form(spark, planted):
    m = fit_linear(planted, FEATS, "y")
    pdf = planted.toPandas()
    X = np.c_[np.ones(len(pdf)), pdf[FEATS].to_numpy()]
    beta = np.linalg.lstsq(X, pdf["y"].to_numpy(), rcond=None)[0]
    lr = m.stages[-1]
    assert abs(lr.intercept - beta[0]) < 1e-8
    assert np.allclose(lr.coefficients.toArray(), beta[1:], atol=1e-8)


def test_same_seed_same_predictions(spark, planted):
    def run():
        m = pipeline(FEATS, AdaBoostR2(labelCol="y", nEstimators=3, seed=5)).fit(planted)
        return [r.p for r in add_prediction(m, planted, "p").orderBy("id").limit(50).collect()]
    # Same trees and weights; distributed float sums may differ in the last bit.
    assert np.allclose(run(), run(), rtol=0, atol=1e-12)


def _constant(v):
    return Tree([-1], [0.0], [0], [0], [v])


def test_weighted_median(spark):
    df = spark.createDataFrame([(Vectors.dense([0.0]),)], ["features"])
    m = AdaBoostR2Model(trees=[_constant(v) for v in (1.0, 5.0, 3.0)], alphas=[0.2, 0.5, 0.3])
    assert m.transform(df).first().prediction == 3.0       # sorted cdf 0.2, 0.5 (3.0), 1.0
    m2 = AdaBoostR2Model(trees=[_constant(v) for v in (1.0, 5.0, 3.0)], alphas=[0.6, 0.2, 0.2])
    assert m2.transform(df).first().prediction == 1.0


def test_trees_as_arrays_predict_as_the_models(spark, planted):
    fitted = pipeline(FEATS, random_forest("y", n_estimators=5, max_depth=7, seed=2)).fit(planted)
    forest = fitted.stages[-1]
    pdf = fitted.transform(planted).select(*FEATS, "prediction").toPandas()
    trees = [Tree.of(t) for t in forest.trees]
    got = sum(t.predict(pdf[FEATS].to_numpy()) for t in trees) / len(trees)
    assert np.allclose(got, pdf["prediction"].to_numpy(), rtol=0, atol=1e-12)
    assert sum(len(t.feature) for t in trees) == forest.totalNumNodes


def _minimum(x, y, c, eps):
    """Least value of the SVR objective with one feature, by nested golden sections (convex in w and in b)."""
    def golden(f, low, high, rounds=70):
        g = (math.sqrt(5) - 1) / 2
        for _ in range(rounds):
            a, b = high - g * (high - low), low + g * (high - low)
            low, high = (low, b) if f(a) < f(b) else (a, high)
        return f((low + high) / 2)

    def at(w):
        r = y - w * x
        return w * w / (2 * c * len(x)) + golden(lambda b: np.maximum(np.abs(r - b) - eps, 0).mean(), r.min() - 1, r.max() + 1)
    return golden(at, -50.0, 50.0)


@pytest.mark.parametrize("scale", [0.1, 1.0])
def test_svr_reaches_the_minimum_of_its_objective(spark, scale):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, scale, 300)
    y = 10 * x + rng.normal(0, 0.02, 300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x1 double, y double")
    for c in (0.1, 1.0, 10.0, 100.0):
        m = pipeline(["x1"], EpsilonSVR(labelCol="y", kernel="linear", C=c, epsilon=0.01)).fit(df).stages[-1]
        least = _minimum(x, y, c, 0.01)
        assert least * (1 - 1e-6) <= m.objective <= 1.02 * least and m.converged
        w, b = m.weights[0], m.intercept
        assert math.isclose(w * w / (2 * c * 300) + np.maximum(np.abs(y - w * x - b) - 0.01, 0).mean(), m.objective, rel_tol=1e-6)


def test_gamma_changes_the_polynomial(spark, planted):
    def fit(g):
        return pipeline(FEATS, EpsilonSVR(labelCol="y", kernel="poly", C=0.01, gamma=g, epsilon=0.05)).fit(planted).stages[-1]
    a, b = fit(0.1), fit(1.0)
    assert a.objective > b.objective * 1.001 and len(a.weights) == 10


@pytest.mark.parametrize("make", [
    lambda: BaggingRegressor(labelCol="y", nEstimators=3, baseMaxDepth=4, seed=1),
    lambda: BaggingRegressor(labelCol="y", nEstimators=3, maxFeatures=0.67, bootstrapFeatures=True, baseMaxDepth=4, seed=1),
    lambda: BaggingRegressor(labelCol="y", nEstimators=2, maxFeatures=0.67, baseEstimator="forest", baseTrees=3, baseMaxDepth=3, seed=1),
    lambda: AdaBoostR2(labelCol="y", nEstimators=3, seed=1),
    lambda: EpsilonSVR(labelCol="y", kernel="rbf", nComponents=10, maxIter=10),
])
def test_own_models_are_stored_and_read_back(spark, planted, workdir, make):
    fitted = pipeline(FEATS, make()).fit(planted)
    save_model(fitted, workdir + "/pipeline")
    alone = fitted.stages[-1]
    alone.write().overwrite().save(workdir + "/alone")
    want = [r.p for r in add_prediction(fitted, planted, "p").orderBy("id").collect()]
    assert [r.p for r in add_prediction(load_model(workdir + "/pipeline"), planted, "p").orderBy("id").collect()] == want
    again = type(alone).load(workdir + "/alone")
    assert again.uid == alone.uid and again.getOrDefault("predictionCol") == alone.getOrDefault("predictionCol")
    assert [r.prediction for r in again.transform(fitted.stages[0].transform(planted)).orderBy("id").collect()] == want


def test_features_drawn_twice_stay(spark, planted):
    m = pipeline(FEATS, BaggingRegressor(labelCol="y", nEstimators=8, maxFeatures=1.0, bootstrapFeatures=True,
                                         baseMaxDepth=2, seed=3)).fit(planted).stages[-1]
    assert all(len(idx) == 3 for idx, _ in m.members) and any(len(set(idx)) < 3 for idx, _ in m.members)


def test_pca_columns(spark, planted):
    m = fit_pca(planted, FEATS, 2)
    out = pca_columns(m, planted, FEATS, 2)
    assert out.columns == ["id", "y", "pc1", "pc2"] and out.count() == 1500


def test_persist_round_trip(spark, planted, workdir):
    m = fit_linear(planted, FEATS, "y")
    save_model(m, workdir + "/m")
    a = add_prediction(m, planted, "p").orderBy("id").limit(5).collect()
    b = add_prediction(load_model(workdir + "/m"), planted, "p").orderBy("id").limit(5).collect()
    assert [r.p for r in a] == [r.p for r in b]


def test_search_spaces():
    grid = expand_grid({"a": [1, 2], "b": ["x", "y", "z"]})
    assert len(grid) == 6 and grid[0] == {"a": 1, "b": "x"}
    s1 = sample_candidates({"a": [1, 2, 3, 4], "b": [0, 1]}, 3, seed=1)
    assert s1 == sample_candidates({"a": [1, 2, 3, 4], "b": [0, 1]}, 3, seed=1)
    assert len({tuple(sorted(c.items())) for c in s1}) == 3        # no repeats
    d = sample_candidates({"n": randint(10, 500), "b": [True, False]}, 50, seed=42)
    assert all(10 <= c["n"] < 500 for c in d)
    assert tree_depth(None) == 30 and tree_depth(90) == 30 and tree_depth(10) == 10
    est = random_forest("y")
    m = forest_params(est, {"max_features": "auto", "min_samples_split": 5, "n_estimators": 400})
    assert {p.name: v for p, v in m.items()} == {"featureSubsetStrategy": "all", "numTrees": 400}


def test_train_all_small(spark, planted):
    df = planted.withColumn("time", F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz"))
    cfg = SearchConfig(
        forest_space={"n_estimators": [10], "max_depth": [4, 8], "max_features": ["auto"],
                      "min_samples_leaf": [2], "bootstrap": [True]}, forest_iter=2,
        svr_grid={"kernel": ["rbf"], "C": [10.0], "gamma": ["scale"], "epsilon": [0.05]},
        ada_grid={"n_estimators": [3], "learning_rate": [1.0]},
        bagging_space={"base_estimator": ["tree"], "n_estimators": [5], "bootstrap": [True],
                       "base_max_depth": [6], "base_min_samples_leaf": [2]},
        bagging_iter=1, folds=3, svr_max_iter=25, svr_landmarks=64)
    res = train_all(df.drop("id"), "y", time="time", config=cfg)
    assert (res.n_rows, res.n_train) == (1500, 1200)
    cols = res.predictions.columns
    assert all(f"y_{m}" in cols for m in ("media", "rl", "rf", "svr", "ada", "bagging"))
    m = {r.model: r for r in res.metrics.collect()}
    assert set(m) == {"media", "rl", "rf", "svr", "ada", "bagging"}
    assert m["rf"].rmse < m["media"].rmse
    assert res.best["rf"]["max_depth"] in (4, 8) and res.best["svr"]["passes"] > 0
    assert res.best["rf"]["effective"]["n_estimators"] == 10


def test_equal_candidates_are_fitted_once(spark, planted):
    from helioframe.models.search import cross_validate
    data = planted.withColumn("fold", (F.col("id") % 3).cast("int"))
    cands = expand_grid({"n_estimators": [3], "max_depth": [2, 3], "min_samples_split": [2, 5, 10]})
    model, best, scores = cross_validate(data, FEATS, "y", random_forest("y", seed=1), cands, forest_params, k=3)
    assert len(scores) == 6 and len(model.avgMetrics) == 2
    assert scores[:3] == [scores[0]] * 3 and best["effective"]["maxDepth"] == best["max_depth"]


def test_training_on_components(spark, planted):
    df = planted.withColumn("time", F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz")).drop("id")
    res = train_all(df, "y", time="time", models=("media", "rl"), components=2)
    assert {"pc1", "pc2", "y_rl"} <= set(res.predictions.columns) and "x1" not in res.predictions.columns
    assert len(expand_grid(SearchConfig.principal_components().svr_grid)) == 36
    assert SearchConfig.eight_variables().ada_grid["n_estimators"] == [50, 100, 200]


def test_svr_passes_read_packed_rows(spark):
    """A pass over the rows reads a few rows of bytes, whatever the kernel's width, and sums all of them."""
    from pyspark.ml.functions import vector_to_array

    from helioframe.models import svr
    rng = np.random.default_rng(5)
    x, y = rng.normal(0, 1, (3000, 3)), rng.normal(0, 1, 3000)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "y"]).repartition(3)
    packed = svr._packed(df.select(vector_to_array("features").alias("x"), "y"), 3)
    assert packed.count() <= 3000 // 256 + 6
    omega, u = rng.normal(0, 1, (7, 3)), rng.uniform(0, 6, 7)
    for kernel in ("linear", "poly", "rbf"):
        def phi(rows, kernel=kernel):
            return svr._mapped(rows, kernel, 2, 0.7, omega.tolist(), u.tolist())
        z = phi(x)
        one = math.sqrt(2 / 7) * np.cos(x[5] @ omega.T + u) if kernel == "rbf" else \
            [0.7 * a * b * (1 if i == j else math.sqrt(2)) for i, a in enumerate(x[5]) for j, b in enumerate(x[5]) if i <= j]
        assert z[5] == pytest.approx(x[5] if kernel == "linear" else one)
        got = svr._sums(packed, 3, phi, lambda a, b: np.concatenate([[len(b)], a.sum(axis=0), b @ a]))
        assert got == pytest.approx(np.concatenate([[3000], z.sum(axis=0), y @ z]), rel=1e-9, abs=1e-9)
