"""Bagging regressor: the mean of base models fit on row samples and
feature subsets.

* Trees on all features (``max_features=1.0``, no feature bootstrap): this
  is exactly a random forest whose trees consider every feature at every
  split, so it is delegated to ``RandomForestRegressor(featureSubsetStrategy
  ='all', subsamplingRate=max_samples, bootstrap=...)`` — one distributed
  training job for all members.
* Otherwise each member draws its features on the driver (seeded), fits the
  base estimator on ``sample(withReplacement=bootstrap,
  fraction=max_samples)`` of the rows restricted to those features (drawn
  with replacement, a feature may stand several times), and the prediction
  is the mean of the members, all evaluated in one vectorised pass.
* Beyond ``ROWS_PER_TASK`` rows the trees of either kind are grown together
  in passes over packed rows (:mod:`helioframe.models.packed_trees`).
"""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol,
                                     HasPredictionCol, HasSeed)
from pyspark.ml.regression import (DecisionTreeRegressor,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.base import ROWS_PER_TASK, spread
from helioframe.models.packed_trees import Member, cuts, grow, pack
from helioframe.models.persist import StoredModel
from helioframe.models.simple import tree_depth
from helioframe.models.trees import Tree, ensemble


class _BagParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    nEstimators = Param(Params._dummy(), "nEstimators", "number of members", TypeConverters.toInt)
    maxSamples = Param(Params._dummy(), "maxSamples", "row fraction per member",
                       TypeConverters.toFloat)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "feature fraction per member",
                        TypeConverters.toFloat)
    bootstrap = Param(Params._dummy(), "bootstrap", "rows drawn with replacement",
                      TypeConverters.toBoolean)
    bootstrapFeatures = Param(Params._dummy(), "bootstrapFeatures",
                              "features drawn with replacement", TypeConverters.toBoolean)
    baseEstimator = Param(Params._dummy(), "baseEstimator", "'tree' or 'forest'",
                          TypeConverters.toString)
    baseMaxDepth = Param(Params._dummy(), "baseMaxDepth", "base depth (0 = unlimited)",
                         TypeConverters.toInt)
    baseMinSamplesLeaf = Param(Params._dummy(), "baseMinSamplesLeaf", "base leaf size",
                               TypeConverters.toInt)
    baseTrees = Param(Params._dummy(), "baseTrees", "trees per forest member",
                      TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "split candidates per feature", TypeConverters.toInt)
    parallelism = Param(Params._dummy(), "parallelism", "members fitted at once",
                        TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(nEstimators=10, maxSamples=1.0, maxFeatures=1.0, bootstrap=True,
                         bootstrapFeatures=False, baseEstimator="tree", baseMaxDepth=0,
                         baseMinSamplesLeaf=1, baseTrees=100, maxBins=32, parallelism=4, seed=42,
                         featuresCol="features", labelCol="label", predictionCol="prediction")


class BaggingRegressor(Estimator, _BagParams):
    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction",
                 nEstimators=10, maxSamples=1.0, maxFeatures=1.0, bootstrap=True,
                 bootstrapFeatures=False, baseEstimator="tree", baseMaxDepth=0,
                 baseMinSamplesLeaf=1, baseTrees=100, maxBins=32, parallelism=4, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)

    def _g(self, p):
        return self.getOrDefault(p)

    def _fit(self, dataset: DataFrame) -> "BaggingModel":
        fc, lc = self.getFeaturesCol(), self.getLabelCol()
        dataset = dataset.select(fc, lc)
        n = dataset.count()
        depth = tree_depth(self._g(self.baseMaxDepth) or None)
        leaf = self._g(self.baseMinSamplesLeaf)
        n_est, seed = self._g(self.nEstimators), self._g(self.seed)
        frac, feat_frac = self._g(self.maxSamples), self._g(self.maxFeatures)
        boot, boot_f = self._g(self.bootstrap), self._g(self.bootstrapFeatures)
        base, bins = self._g(self.baseEstimator), self._g(self.maxBins)
        packed = base == "tree" and n > ROWS_PER_TASK
        if not packed:
            dataset = spread(dataset, n)
        if not packed and base == "tree" and feat_frac >= 1.0 and not boot_f:
            rf = RandomForestRegressor(featuresCol=fc, labelCol=lc, numTrees=n_est,
                                       featureSubsetStrategy="all", subsamplingRate=frac,
                                       bootstrap=boot, maxDepth=depth, maxBins=bins,
                                       minInstancesPerNode=leaf, seed=seed).fit(dataset)
            return self._copyValues(BaggingModel(forest=rf))
        n_feat = len(dataset.select(fc).first()[0])
        k = max(1, int(round(feat_frac * n_feat)))
        rng = random.Random(seed)
        subsets = []
        for _ in range(n_est):       # drawn up front: the draws do not depend on fit order
            if boot_f:
                subsets.append(sorted(rng.randrange(n_feat) for _ in range(k)))
            else:
                subsets.append(sorted(rng.sample(range(n_feat), k)))

        if packed:
            rows = pack(dataset, fc, lc, n, max(bins * bins, 10_000), seed)
            trees = grow(rows, cuts(rows.sample[:, :-1], bins),
                         [Member(tuple(idx), depth, leaf, frac if boot or frac < 1.0 else None, boot, seed + i)
                          for i, idx in enumerate(subsets)])
            rows.drop()
            return self._copyValues(BaggingModel(members=[(idx, [t]) for idx, t in zip(subsets, trees)]))

        def fit_member(i):
            idx = subsets[i]
            rows = dataset
            if boot or frac < 1.0:
                rows = dataset.sample(withReplacement=boot, fraction=frac, seed=seed + i)
            x = vector_to_array(F.col(fc))
            sliced = rows.withColumn("__xs", array_to_vector(F.array(*[x[j] for j in idx])))
            if base == "forest":
                est = RandomForestRegressor(featuresCol="__xs", labelCol=lc,
                                            numTrees=self._g(self.baseTrees), maxDepth=depth,
                                            maxBins=bins, minInstancesPerNode=leaf, seed=seed + i)
            else:
                est = DecisionTreeRegressor(featuresCol="__xs", labelCol=lc, maxDepth=depth,
                                            maxBins=bins, minInstancesPerNode=leaf, seed=seed + i)
            fitted = est.fit(sliced)
            return idx, [Tree.of(t) for t in (fitted.trees if base == "forest" else [fitted])]

        # Each member fit is its own set of distributed jobs; a few run at once.
        with ThreadPoolExecutor(max_workers=self._g(self.parallelism)) as pool:
            members = list(pool.map(fit_member, range(n_est)))
        return self._copyValues(BaggingModel(members=members))


class BaggingModel(Model, _BagParams, StoredModel):
    """Either a forest that stands for all members, or members (their features, their trees)."""

    def __init__(self, members: list[tuple[list[int], list[Tree]]] | None = None, forest=None):
        super().__init__()
        self.members, self.forest = list(members or []), forest

    def state(self) -> dict:
        return {"members": [[idx, [t.state() for t in trees]] for idx, trees in self.members]}

    def parts(self) -> list:
        return [self.forest] if self.forest else []

    @classmethod
    def restored(cls, state: dict, parts: list) -> "BaggingModel":
        return cls([(idx, [Tree(*t) for t in trees]) for idx, trees in state["members"]], parts[0] if parts else None)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fc, cols = self.getFeaturesCol(), dataset.columns
        if self.forest:
            rf = self.forest.copy().setFeaturesCol(fc).setPredictionCol("__p")
            return rf.transform(dataset).select(*cols, F.col("__p").alias(self.getPredictionCol()))
        members = self.members

        def mean(x):
            return sum(sum(t.predict(x[:, idx]) for t in trees) / len(trees) for idx, trees in members) / len(members)

        return dataset.select(*cols, ensemble(fc, mean).alias(self.getPredictionCol()))
