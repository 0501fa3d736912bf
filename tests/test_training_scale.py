"""The training stage at scale: no pass by one partition after the other, no whole trees on the driver for scores."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from helioframe.models import forest, grower
from helioframe.models.forest import bagging_plan, forest_plan, forest_scores
from helioframe.models.grower import Fit, binned, grow
from helioframe.models.least_squares import cross_products


def table(spark, x, y, fold):
    rows = [(i, [float(v) for v in a], float(b), int(f)) for i, (a, b, f) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(rows, "id long, a array<double>, y double, fold int") \
        .select("id", array_to_vector("a").alias("features"), "y", "fold")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 50, 900), rng.integers(0, 9, 900)]).astype(float)
    y = np.round(x[:, 0] * x[:, 1] / 9 + rng.normal(0, 3, 900), 2)
    df = table(spark, x, y, np.arange(900) // 300)
    rows = binned(df.repartition(3), "features", "y", "fold", ["id"])
    yield df, rows
    rows.drop()


def test_least_squares_in_as_many_jobs_for_many_partitions(spark, data):
    counts = []
    for parts in (2, 9):
        group = f"least-{parts}"
        df = data[0].repartition(parts)
        spark.sparkContext.setJobGroup(group, group)
        assert cross_products(df, "features", "y")[0] == 900
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert counts[0] == counts[1]


@pytest.mark.parametrize("most", [0, 100, 100_000])
def test_scores_without_trees_on_the_driver(data, monkeypatch, most):
    rows = data[1]
    plans = [forest_plan({"n_estimators": n, "max_depth": d, "min_samples_leaf": 2}) for n in (2, 3) for d in (3, None)]
    plans.append(bagging_plan({"base_estimator": "extra", "n_estimators": 2, "base_trees": 2, "bootstrap": False}))
    want = []
    got = {r["idx"]: r for r in rows.df.collect()}
    bins = np.array([np.frombuffer(got[i]["bins"], "<u2") for i in range(900)])
    y, fold = (np.array([got[i][c] for i in range(900)]) for c in ("y", "fold"))
    for plan in plans:
        parts = []
        for held in range(3):
            here = fold == held
            members = plan.members(2, 4, held)
            trees = grow(rows, [fit for member in members for fit in member])
            p = sum(t.arrays()[4][grower.walk(t.arrays(), bins[here])] for t in trees) / len(trees)
            parts.append(1 - ((y[here] - p) ** 2).sum() / ((y[here] - y[here].mean()) ** 2).sum())
        want.append(np.mean(parts))
    monkeypatch.setattr(grower, "SMALL", most)
    monkeypatch.setattr(grower, "LEAST", 100)
    monkeypatch.setattr(grower, "CHUNK", 64)
    monkeypatch.setattr(forest, "CHUNK", 64, raising=False)
    monkeypatch.setattr(forest, "grow", lambda *a: pytest.fail("trees on the driver"))
    assert forest_scores(rows, plans, 4) == pytest.approx(want, rel=1e-9)


def test_levels_in_parts_and_many_weights(data, monkeypatch):
    rng = np.random.default_rng(2)
    bins, y = rng.integers(0, 200, (3000, 4)).astype(np.uint8), rng.normal(size=3000)
    weight, edges = rng.integers(1, 5, 3000), [np.arange(200.0)] * 4
    for fit in (Fit(min_leaf=3), Fit(tried=2, seed=5), Fit(features=(1, 3), extra=True, max_depth=7)):
        trees = []
        for part in (1, 1 << 16):
            monkeypatch.setattr(grower, "PART", part)
            tree = grower.grow_in_memory(fit, 7, 0, bins, weight, y, edges, [True] * 4)
            trees.append((tree.feature, tree.cut, tree.left, tree.right, np.round(tree.value, 9).tolist()))
        assert trees[0] == trees[1] and len(trees[0][0]) > 20
