"""Trees grown in shared passes, against recursive brute force and fixed draws."""
import itertools

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from helioframe.models import grower
from helioframe.models.base import add_prediction
from helioframe.models.draws import BLOCK, Sample, mixed, uniform, weighted_counts
from helioframe.models.forest import (ForestPlan, GrownForest, bagging_plan,
                                      forest_plan, search_forests)
from helioframe.models.grower import NO_LIMIT, Fit, binned, grow
from helioframe.models.simple import load_model, save_model


def brute_tree(x, y, fit, key=None, depth=0, weight=None):
    """The same tree by recursion over sorted rows: nested (feature, threshold, left, right) or a mean."""
    weight = np.ones(len(y)) if weight is None else weight
    key = int(mixed(fit.seed)) if key is None else key
    mean = float(weight @ y / weight.sum())
    if depth >= fit.max_depth or len(y) < max(fit.min_split, 2) or y.min() == y.max():
        return mean
    features = [f for f in (fit.features or range(x.shape[1])) if len(set(x[:, f])) > 1]
    if fit.tried:
        features = sorted(sorted(set(features), key=lambda f: int(mixed(key, f + 16)))[:fit.tried])
    best = None
    for f in sorted(set(features)):
        values = sorted(set(x[:, f]))
        cuts = list(zip(values, values[1:]))
        if fit.extra:
            drawn = values[0] + uniform(mixed(key, f + 4096)) * (values[-1] - values[0])
            cuts = [(a, b) for a, b in cuts if a <= drawn < b]
        for a, b in cuts:
            left = x[:, f] <= a
            if min(left.sum(), (~left).sum()) < fit.min_leaf:
                continue
            gain = (weight[left] @ y[left]) ** 2 / weight[left].sum() + (weight[~left] @ y[~left]) ** 2 / weight[~left].sum()
            if best is None or gain > best[0] + 1e-12 * abs(best[0]):
                best = (gain, f, (a + b) / 2, left)
    if best is None:
        return mean
    _, f, t, left = best
    return (f, t, brute_tree(x[left], y[left], fit, int(mixed(key, 1)), depth + 1, weight[left]),
            brute_tree(x[~left], y[~left], fit, int(mixed(key, 2)), depth + 1, weight[~left]))


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    return (tree.feature[node], tree.threshold[node], nested(tree, tree.left[node]), nested(tree, tree.right[node]))


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return abs(a - b) <= 1e-9 * max(1, abs(b))
    return a[0] == b[0] and abs(a[1] - b[1]) < 1e-9 and same(a[2], b[2]) and same(a[3], b[3])


def height(tree):
    return 0 if not isinstance(tree, tuple) else 1 + max(height(tree[2]), height(tree[3]))


def table(spark, x, y, fold=None):
    rows = [(i, [float(v) for v in a], float(b), int(fold[i]) if fold is not None else 0) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a array<double>, y double, fold int")
    return df.select("id", array_to_vector("a").alias("features"), "y", "fold").repartition(3)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 40, 700), rng.integers(0, 12, 700), rng.integers(0, 3, 700)]).astype(float)
    y = np.round(np.sin(x[:, 0]) * 8 + x[:, 1] ** 2 / 7 + rng.normal(0, 2, 700), 3)
    rows = binned(table(spark, x, y), "features", "y", order=["id"])
    yield x, y, rows
    rows.drop()


FITS = [Fit(), Fit(max_depth=3), Fit(min_split=40), Fit(min_leaf=17), Fit(features=(1, 2)), Fit(seed=3, tried=1),
        Fit(seed=4, extra=True, min_leaf=3), Fit(seed=5, extra=True, tried=2, max_depth=6)]


@pytest.mark.parametrize("small", [0, 60, 100_000])
def test_equal_to_recursion(data, monkeypatch, small):
    x, y, rows = data
    monkeypatch.setattr(grower, "SMALL", small)
    for fit, tree in zip(FITS, grow(rows, FITS), strict=True):
        assert same(nested(tree.tree()), brute_tree(x, y, fit)), fit


def test_given_draws_of_rows(data):
    x, y, rows = data
    fits = [Fit(seed=9, sample=(0.5, True), min_leaf=2), Fit(seed=9, sample=(0.3, False)), Fit(seed=1, bootstrap=True, max_depth=5),
            Fit(seed=2, sample=(0.5, False), bootstrap=True)]
    for fit, tree in zip(fits, grow(rows, fits), strict=True):
        weight = grower._weights(fit, rows.n, {}, np.arange(rows.n), np.zeros(rows.n, int), None)
        share = fit.sample[0] if fit.sample else 1.0
        assert weight.sum() == int(share * rows.n)
        held = weight > 0
        assert same(nested(tree.tree()), brute_tree(x[held], y[held], fit, weight=weight[held].astype(float)))


@pytest.mark.parametrize("small", [0, 100_000])
def test_deeper_than_thirty(spark, monkeypatch, small):
    monkeypatch.setattr(grower, "SMALL", small)
    x = np.arange(45, dtype=float)[:, None]
    y = 4.0 ** np.arange(45)
    rows = binned(table(spark, x, y), "features", "y")
    tree = nested(grow(rows, [Fit()])[0].tree())
    assert same(tree, brute_tree(x, y, Fit())) and height(tree) > 30
    wide = nested(grow(rows, [Fit(min_split=20)])[0].tree())
    assert height(wide) < height(tree) and same(wide, brute_tree(x, y, Fit(min_split=20)))


def test_many_values_become_quantiles(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(3000, 2)), rng.normal(size=3000)
    y += 5 * (x[:, 0] > 0.3)
    df = table(spark, x, y)
    rows = binned(df, "features", "y", max_bins=64)
    assert rows.exact == [False, False] and all(len(e) <= 65 for e in rows.edges)
    tree = grow(rows, [Fit(max_depth=1)])[0].tree()
    assert tree.feature[0] == 0 and abs(tree.threshold[0] - 0.3) < 0.05


@pytest.mark.parametrize(("n", "size"), [(1, 1), (10, 4), (5000, 2500), (12_345, 12_345), (100_000, 50_000)])
@pytest.mark.parametrize("again", [True, False])
def test_samples_have_exact_sizes(n, size, again):
    for seed in range(3):
        sample = Sample(n, size, again, seed)
        whole = sample.counts(np.arange(n))
        assert whole.sum() == size and (again or whole.max() <= 1)
        parts = np.array_split(np.random.default_rng(seed).permutation(n), 7)
        got = np.empty(n, np.int64)
        for p in parts:
            if len(p):
                got[p] = sample.counts(p)
        assert (got == whole).all()
        inner = Sample(size, size, True, seed + 1, sample)
        drawn = inner.counts(np.arange(n))
        assert drawn.sum() == size and not drawn[whole == 0].any()


def test_samples_are_uniform():
    n = 4 * BLOCK
    for again in (True, False):
        total = sum(Sample(n, n // 2, again, seed).counts(np.arange(n)) for seed in range(200))
        by_block = total.reshape(16, -1).sum(axis=1)
        expected = 200 * (n // 2) / 16
        assert ((by_block - expected) ** 2 / expected).sum() < 40       # chi-square, 15 degrees
    assert Sample(5_000_000_000, 2_500_000_000, False, 1)._blocks() > 0
    got = Sample(5_000_000_000, 2_500_000_000, False, 1).counts(np.arange(4096))
    assert 1800 < got.sum() < 2300 and got.max() == 1


def test_weighted_draws():
    rng = np.random.default_rng(0)
    weights = np.array([0.0, 1.0, 3.0, 0.0, 6.0, 0.0])
    got = weighted_counts(weights, 100_000, rng)
    assert got.sum() == 100_000 and not got[weights == 0].any()
    expected = weights[weights > 0] / 10 * 100_000
    assert ((got[weights > 0] - expected) ** 2 / expected).sum() < 14
    assert weighted_counts(np.zeros(3), 5, rng).sum() == 0 and len(weighted_counts(np.zeros(0), 5, rng)) == 0


def test_estimator_and_persistence(spark, data, workdir):
    x, y, _ = data
    df = table(spark, x, y)
    for plan in (ForestPlan(n_estimators=4, max_features="sqrt", min_samples_leaf=2),
                 bagging_plan({"n_estimators": 3, "base_estimator": "extra", "base_trees": 4, "max_samples": 0.5,
                               "max_features": 0.67, "bootstrap_features": True, "base_min_samples_split": 9}),
                 bagging_plan({"n_estimators": 2, "base_estimator": "forest", "base_trees": 3, "base_max_depth": 4})):
        model = GrownForest(plan, labelCol="y", seed=3).fit(df)
        model.write().overwrite().save(workdir + "/m")
        want = [r["prediction"] for r in model.transform(df).orderBy("id").collect()]
        again = type(model).load(workdir + "/m")
        assert [r["prediction"] for r in again.transform(df).orderBy("id").collect()] == want
        assert again.plan == plan and np.corrcoef(want, y)[0, 1] > 0.5
    with pytest.raises(ValueError, match="unknown base"):
        ForestPlan(base="other").members(3, 0)


def search(spark, df, candidates, to_plan):
    group = f"search-{len(candidates)}-{id(candidates)}"
    spark.sparkContext.setJobGroup(group, group)
    got = search_forests(df, ["x0", "x1", "x2"], "y", candidates, to_plan, order=["id"], seed=1)
    count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext._jsc.sc().clearJobGroup()
    return got, count


def test_search_shares_its_passes(spark, data):
    x, y, _ = data
    fold = np.arange(len(y)) % 3
    df = table(spark, x, y, fold)
    df = df.select("id", "y", "fold", *[vector_to_array("features")[k].alias(f"x{k}") for k in range(3)])
    few = [{"n_estimators": 2, "max_depth": 4}]
    many = [dict(zip(("n_estimators", "max_depth", "min_samples_split", "bootstrap"), c))
            for c in itertools.product((2, 3), (4, None), (2, 30), (True, False))]
    (_, _, one), a = search(spark, df, few, forest_plan)
    (model, best, scores), b = search(spark, df, many, forest_plan)
    assert a == b and len(scores) == 16
    assert scores[many.index({"n_estimators": 2, "max_depth": 4, "min_samples_split": 2, "bootstrap": True})] == pytest.approx(one[0])
    assert scores[0] != scores[2] and best["effective"]["max_depth"] == best["max_depth"]
    # The scores are those of models fitted without the fold.
    for cand in (many[0], many[-1]):
        parts = []
        for held in range(3):
            rest = np.flatnonzero(fold != held)
            here = np.flatnonzero(fold == held)
            # In the search, rows lie fold by fold; the same order here gives the same samples.
            order = rest[np.lexsort((rest, fold[rest]))]
            plan = forest_plan(cand)
            rows = binned(table(spark, x[order], y[order]), "features", "y", order=["id"])
            trees = [t.tree() for t in grow(rows, [f for m in plan.members(3, 1) for f in m])]
            p = sum(t.predict(x[here]) for t in trees) / len(trees)
            parts.append(1 - ((y[here] - p) ** 2).sum() / ((y[here] - y[here].mean()) ** 2).sum())
        assert scores[many.index(cand)] == pytest.approx(np.mean(parts))
    pred = add_prediction(model, df, "p")
    assert pred.count() == len(y)
    bags = [{"base_estimator": b, "n_estimators": 2, "base_trees": 2, "max_samples": 0.5, "base_max_depth": d}
            for b in ("tree", "forest", "extra") for d in (3, 6)]
    (_, _, scores), _ = search(spark, df, bags, bagging_plan)
    assert len(set(scores)) == 6


def test_no_rows(spark):
    df = table(spark, np.empty((0, 1)), np.empty(0))
    with pytest.raises(ValueError, match="no rows"):
        binned(df, "features", "y")


def test_saved_in_a_pipeline(spark, data, workdir):
    x, y, _ = data
    df = table(spark, x, y)
    model = GrownForest(ForestPlan(n_estimators=2, max_depth=NO_LIMIT), labelCol="y").fit(df)
    save_model(PipelineModel([model]), workdir + "/p")
    assert [r[0] for r in load_model(workdir + "/p").transform(df).orderBy("id").select("prediction").collect()] == \
        [r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()]
