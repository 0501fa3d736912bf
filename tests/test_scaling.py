"""Fits read rows in bounded tasks, and searches share what their candidates have in common."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from helioframe.models import base, grower
from helioframe.models.adaboost import AdaBoostR2
from helioframe.models.search import cross_validate, expand_grid
from helioframe.models.simple import decision_tree
from helioframe.plans.training_job import ada_params


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(600).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3).cast("int").alias("fold"),
                                   ((F.col("id") % 7) ** 2 + F.col("id") % 2).alias("y")).coalesce(1).localCheckpoint()


def test_no_task_gets_all_rows(spark, rows, monkeypatch):
    assert base.spread(rows) is rows
    monkeypatch.setattr(base, "ROWS_PER_TASK", 50)
    sizes = [r["count"] for r in base.spread(rows).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == 600
    assert base.pipeline(["x"], decision_tree("y", 2)).fit(rows).transform(rows).count() == 600


def test_rounds_are_prefixes_in_a_search(rows, monkeypatch):
    fitted, fit = [], AdaBoostR2._fit
    monkeypatch.setattr(AdaBoostR2, "_fit", lambda self, df: fitted.append(1) or fit(self, df))
    cands = expand_grid({"n_estimators": [1, 3], "learning_rate": [1.0]})
    _, _, scores = cross_validate(rows, ["x"], "y", AdaBoostR2(labelCol="y", maxDepth=1), cands, ada_params, k=3)
    assert len(fitted) == 3 + 1                       # one for each fold, and the best on all rows
    alone = [cross_validate(rows, ["x"], "y", AdaBoostR2(labelCol="y", maxDepth=1), [c], ada_params, k=3)[2][0] for c in cands]
    assert scores == pytest.approx(alone, rel=1e-9)


def test_folds_out_of_range(rows):
    with pytest.raises(ValueError, match="Fold number"):
        cross_validate(rows.withColumn("fold", F.col("fold") + 1), ["x"], "y", decision_tree("y", 1), [{}], lambda e, c: {}, k=3)


def test_dense_sums_are_the_sorted_ones(monkeypatch):
    rng = np.random.default_rng(1)
    front, bins = rng.integers(3, 6, 500), rng.integers(0, 8, (500, 2))
    weight, y = rng.integers(1, 4, 500), rng.normal(0, 1, 500)
    dense = grower._histogram(front, bins, weight, y, [0, 1], 2, 8)
    monkeypatch.setattr(grower, "DENSE", 0)
    for a, b in zip(dense, grower._histogram(front, bins, weight, y, [0, 1], 2, 8), strict=True):
        assert a.dtype == b.dtype and a == pytest.approx(b)
