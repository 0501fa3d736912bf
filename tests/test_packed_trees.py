"""Trees of many rows: grown in passes over packed rows, alike to MLlib's."""

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor

from helioframe.models import adaboost, bagging, packed_trees
from helioframe.models.adaboost import AdaBoostR2
from helioframe.models.bagging import BaggingRegressor
from helioframe.models.base import add_prediction, assembler, pipeline
from helioframe.models.simple import load_model, save_model

FEATS = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=3000), rng.integers(0, 9, 3000), rng.normal(size=3000)])
    y = np.where(x[:, 0] > 0.3, 5.0, x[:, 1]) + np.abs(x[:, 2]) + rng.normal(size=3000) / 10
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], [*FEATS, "y"]).repartition(3).cache()


@pytest.fixture()
def many(monkeypatch):
    """Every table counts as one of many rows, and MLlib fits no tree."""

    def on():
        for module in (adaboost, bagging):
            monkeypatch.setattr(module, "ROWS_PER_TASK", 100)
            monkeypatch.setattr(module.DecisionTreeRegressor, "fit", lambda *a: pytest.fail("a fit by MLlib"))
        monkeypatch.setattr(bagging.RandomForestRegressor, "fit", lambda *a: pytest.fail("a fit by MLlib"))
    return on


def _predicted(model, rows):
    return np.array([r["p"] for r in add_prediction(model, rows, "p").orderBy(*FEATS).collect()])


@pytest.mark.parametrize("make", [
    lambda: AdaBoostR2(labelCol="y", nEstimators=4, maxDepth=2, learningRate=0.5),
    lambda: BaggingRegressor(labelCol="y", nEstimators=2, bootstrap=False, maxFeatures=0.67, baseMaxDepth=4, baseMinSamplesLeaf=4, seed=5),
    lambda: BaggingRegressor(labelCol="y", nEstimators=2, bootstrap=False, baseMaxDepth=4),
], ids=["ada", "subspace", "whole"])
def test_packed_rows_give_mllibs_trees(rows, many, monkeypatch, make):
    monkeypatch.setattr(adaboost, "CUT", 2)
    before = _predicted(pipeline(FEATS, make()).fit(rows), rows)
    many()
    assert np.allclose(before, _predicted(pipeline(FEATS, make()).fit(rows), rows), rtol=1e-9)


def test_open_nodes_beyond_a_pass_wait(rows, many, monkeypatch):
    many()
    make = lambda: BaggingRegressor(labelCol="y", nEstimators=2, maxSamples=0.7, baseMaxDepth=3, seed=1)
    whole = pipeline(FEATS, make()).fit(rows)
    monkeypatch.setattr(packed_trees, "CELLS", 150)
    assert np.allclose(_predicted(whole, rows), _predicted(pipeline(FEATS, make()).fit(rows), rows), rtol=1e-9)


def test_drawn_bag_is_stored_and_close(rows, many, workdir):
    many()
    model = pipeline(FEATS, BaggingRegressor(labelCol="y", nEstimators=8, maxSamples=0.5, baseMaxDepth=6, seed=2)).fit(rows)
    save_model(model, f"{workdir}/bag")
    got, y = _predicted(model, rows), np.array([r["y"] for r in rows.orderBy(*FEATS).collect()])
    assert np.array_equal(got, _predicted(load_model(f"{workdir}/bag"), rows))
    assert 1 - ((y - got) ** 2).mean() / y.var() > 0.9
    assert len({str(trees[0].state()) for _, trees in model.stages[-1].members}) == 8


@pytest.mark.parametrize("rate,again", [(1.0, True), (0.5, True), (0.3, False)])
def test_draws(rate, again):
    from helioframe.models.draws import mixed
    got = packed_trees.Member((0,), 1, 1, rate, again, 4).draws(mixed(np.arange(200_000)))
    assert abs(got.mean() - rate) < 0.01
    assert abs((got == 0).mean() - (np.exp(-rate) if again else 1 - rate)) < 0.01


def test_missing_label_is_an_error(spark, many):
    many()
    df = spark.createDataFrame([(float(i), None if i == 7 else float(i)) for i in range(200)], "x double, y double")
    with pytest.raises(Exception, match="must not be null"):
        pipeline(["x"], AdaBoostR2(labelCol="y", nEstimators=1)).fit(df)


def test_constant_labels_stay_a_leaf(spark, many):
    df = assembler(["x"]).transform(spark.createDataFrame([(float(i), 2.5) for i in range(200)], "x double, y double"))
    tree = DecisionTreeRegressor(labelCol="y").fit(df)
    many()
    model = BaggingRegressor(labelCol="y", nEstimators=1, bootstrap=False).fit(df)
    assert tree.numNodes == len(model.members[0][1][0].feature) == 1 and model.members[0][1][0].value == [2.5]
