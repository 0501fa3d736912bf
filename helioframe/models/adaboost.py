"""AdaBoost.R2 (Drucker, 1997) with MLlib regression trees.

Each round fits a depth-limited ``DecisionTreeRegressor`` on the current
sample weights (``weightCol``; weighted fitting instead of weighted
resampling, so a run is deterministic), then one aggregation pass gives
the largest absolute error and the weighted mean linear loss, from which
the tree weight and the new sample weights follow. The weights are an
expression over the trees since the last cut; every ``CUT`` rounds the rows
are written with their weights to the shared checkpoint folder (and the
table before is dropped), so the plan stays short and a lost executor
recomputes a few rounds. Beyond ``ROWS_PER_TASK`` rows the trees are grown in
passes over packed rows (:mod:`helioframe.models.packed_trees`).

Prediction is the weighted median of the tree predictions; all trees are
evaluated in one vectorised pass.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol,
                                     HasPredictionCol, HasSeed)
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.base import ROWS_PER_TASK
from helioframe.models.packed_trees import Member, Step, cuts, errors, grow, pack, reweighted
from helioframe.models.persist import StoredModel
from helioframe.models.trees import Tree, ensemble, weighted_median
from helioframe.session import discard, ensure_checkpoint_dir, materialize

# Rounds between two writes of the weights.
CUT = 10


class _AdaParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    nEstimators = Param(Params._dummy(), "nEstimators", "maximum number of trees",
                        TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "shrinkage of each tree weight",
                         TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of each tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "split candidates per feature", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(nEstimators=50, learningRate=1.0, maxDepth=3, maxBins=32, seed=0,
                         featuresCol="features", labelCol="label", predictionCol="prediction")


class AdaBoostR2(Estimator, _AdaParams):
    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction",
                 nEstimators=50, learningRate=1.0, maxDepth=3, maxBins=32, seed=0):
        super().__init__()
        self._set(**self._input_kwargs)

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        """Fits that differ only in the number of rounds are prefixes of the longest, which is fitted once."""
        copies = [self.copy(m) for m in paramMaps]
        alike: dict = {}
        for at, est in enumerate(copies):
            key = tuple(sorted((p.name, str(v)) for p, v in est.extractParamMap().items() if p.name != "nEstimators"))
            alike.setdefault(key, []).append(at)

        def models():
            for mine in alike.values():
                rounds = [copies[at].getOrDefault(self.nEstimators) for at in mine]
                longest = copies[mine[rounds.index(max(rounds))]].fit(dataset)
                for at, n in zip(mine, rounds):
                    yield at, copies[at]._copyValues(AdaBoostR2Model(longest.trees[:n], longest.alphas[:n]))

        return models()

    def _fit(self, dataset: DataFrame) -> "AdaBoostR2Model":
        spark = dataset.sparkSession
        ensure_checkpoint_dir(spark)
        fc, lc = self.getFeaturesCol(), self.getLabelCol()
        lr = self.getOrDefault(self.learningRate)
        n_est = self.getOrDefault(self.nEstimators)
        depth = self.getOrDefault(self.maxDepth)
        seed = self.getOrDefault(self.seed)
        data = dataset.select(F.col(fc).alias("__x"), F.col(lc).cast("double").alias("__y"))
        n = data.count()
        if n > ROWS_PER_TASK:
            return self._fit_packed(data, n)
        data, path = materialize(data.withColumn("__w", F.lit(1.0 / max(n, 1))), "ada-round")
        trees, alphas = [], []
        for t in range(n_est):
            tree = DecisionTreeRegressor(featuresCol="__x", labelCol="__y", weightCol="__w",
                                         maxDepth=depth, maxBins=self.getOrDefault(self.maxBins), seed=seed + t,
                                         predictionCol="__p").fit(data)
            pred = tree.transform(data).withColumn("__e", F.abs(F.col("__y") - F.col("__p")))
            # One pass: L = e / max(e), so sum(w * L) = sum(w * e) / max(e).
            max_err, swe, sw = pred.agg(F.max("__e"), F.sum(F.col("__w") * F.col("__e")),
                                        F.sum("__w")).first()
            max_err = max_err or 0.0
            if max_err <= 0.0:               # perfect fit: keep it and stop
                trees.append(tree)
                alphas.append(1.0)
                break
            pred = pred.withColumn("__l", F.col("__e") / F.lit(max_err))
            lbar = swe / max_err / sw
            if lbar >= 0.5:                  # no better than chance: stop
                if not trees:
                    trees.append(tree)
                    alphas.append(1.0)
                break
            beta = lbar / (1.0 - lbar)
            trees.append(tree)
            alphas.append(lr * math.log(1.0 / beta))
            if t == n_est - 1:
                break
            upd = F.col("__w") / F.lit(sw) * F.pow(F.lit(beta), (F.lit(1.0) - F.col("__l")) * lr)
            data = pred.select("__x", "__y", upd.alias("__w"))
            if (t + 1) % CUT == 0:
                data, new_path = materialize(data, "ada-round")
                discard(spark, path)      # the weights before are no longer read
                path = new_path
        discard(spark, path)
        model = AdaBoostR2Model(trees=[Tree.of(t) for t in trees], alphas=alphas)
        return self._copyValues(model)

    def _fit_packed(self, data: DataFrame, n: int) -> "AdaBoostR2Model":
        """The same rounds in passes over packed rows; the cuts of a round follow its weights of a sample."""
        lr, n_est = self.getOrDefault(self.learningRate), self.getOrDefault(self.nEstimators)
        depth, bins = self.getOrDefault(self.maxDepth), self.getOrDefault(self.maxBins)
        rows = pack(data, "__x", "__y", n, max(bins * bins, 10_000), self.getOrDefault(self.seed), weight=1.0 / n)
        x, y = rows.sample[:, :-1], rows.sample[:, -1]
        w = np.full(len(y), 1.0 / n)
        trees, alphas, steps = [], [], []
        for t in range(n_est):
            tree = grow(rows, cuts(x, bins, w), [Member(tuple(range(rows.width)), depth)], steps)[0]
            max_err, swe, sw = errors(rows, tree, steps)
            if max_err <= 0.0:               # perfect fit: keep it and stop
                trees.append(tree)
                alphas.append(1.0)
                break
            lbar = swe / max_err / sw
            if lbar >= 0.5:                  # no better than chance: stop
                if not trees:
                    trees.append(tree)
                    alphas.append(1.0)
                break
            beta = lbar / (1.0 - lbar)
            trees.append(tree)
            alphas.append(lr * math.log(1.0 / beta))
            if t == n_est - 1:
                break
            steps.append(Step(tree, sw, beta, max_err, lr))
            w = steps[-1].weights(x, y, w)
            if (t + 1) % CUT == 0:
                rows, steps = reweighted(rows, steps), []
        rows.drop()
        return self._copyValues(AdaBoostR2Model(trees=trees, alphas=alphas))


class AdaBoostR2Model(Model, _AdaParams, StoredModel):
    def __init__(self, trees: list[Tree] | None = None, alphas=None):
        super().__init__()
        self.trees = list(trees or [])
        self.alphas = [float(a) for a in (alphas or [])]

    def state(self) -> dict:
        return {"trees": [t.state() for t in self.trees], "alphas": self.alphas}

    @classmethod
    def restored(cls, state: dict, parts: list) -> "AdaBoostR2Model":
        return cls([Tree(*t) for t in state["trees"]], state["alphas"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, alphas = self.trees, np.array(self.alphas)

        def median(x):
            return weighted_median(np.stack([t.predict(x) for t in trees], axis=1), alphas)

        return dataset.select(*dataset.columns, ensemble(self.getFeaturesCol(), median).alias(self.getPredictionCol()))
