"""Trees, forests, extra-trees and bags of them, grown together (:mod:`helioframe.models.grower`).

``ForestPlan`` holds the parameters under their usual names and says which
trees they mean; ``GrownForest`` is the estimator, and ``search_forests``
cross-validates many plans in shared passes: all candidates, folds and
members grow at the same time, one more pass scores them, and the best plan
is grown again on all rows. Plans that differ only in the number of members
share their trees.
"""

from __future__ import annotations

import math
import random
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol,
                                     HasPredictionCol, HasSeed)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.base import FEATURES, assembler
from helioframe.models.draws import mixed
from helioframe.models.grower import CHUNK, NO_LIMIT, Binned, Fit, binned, grow, held_out
from helioframe.models.persist import StoredModel
from helioframe.models.trees import Tree, ensemble
from helioframe.session import discard


def tried_features(rule, width: int) -> int | None:
    """Features tried at a node: ``None`` for all of them."""
    if rule in (None, "auto", "all", 1.0):
        return None
    if rule == "sqrt":
        return max(1, int(math.sqrt(width)))
    if rule == "log2":
        return max(1, int(math.log2(width)))
    return max(1, int(rule)) if isinstance(rule, int) else max(1, int(float(rule) * width))


@dataclass(frozen=True)
class ForestPlan:
    """Parameters of an ensemble.

    ``base``: what a member is: a ``tree``, a ``forest`` or ``extra`` trees
    (``base_trees`` of them). ``max_samples`` and ``feature_share`` are drawn
    for each member, with replacement if ``bootstrap`` and
    ``bootstrap_features``; ``max_features`` are tried at each node.
    """

    n_estimators: int = 100
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: object = None
    bootstrap: bool = True
    max_samples: float = 1.0
    feature_share: float = 1.0
    bootstrap_features: bool = False
    base: str = "tree"
    base_trees: int = 100
    extra: bool = False

    def members(self, width: int, seed: int, held: int | None = None) -> list[list[Fit]]:
        """The trees of each member."""
        if self.base not in ("tree", "forest", "extra"):
            raise ValueError(f"unknown base estimator {self.base!r}")
        drawn = self.bootstrap or self.max_samples < 1.0
        common = Fit(held=held, sample=(float(self.max_samples), bool(self.bootstrap)) if drawn else None,
                     max_depth=NO_LIMIT if self.max_depth is None else int(self.max_depth),
                     min_split=max(2, int(self.min_samples_split)), min_leaf=max(1, int(self.min_samples_leaf)),
                     extra=self.extra or self.base == "extra")
        out = []
        for member in range(int(self.n_estimators)):
            own = int(mixed(seed, member))
            features = self._features(width, own)
            shown = replace(common, features=features, sample_seed=own,
                            tried=tried_features(self.max_features, width if features is None else len(features)))
            if self.base == "tree":
                out.append([replace(shown, seed=own)])
            else:
                out.append([replace(shown, seed=int(mixed(own, t)), bootstrap=self.base == "forest")
                            for t in range(int(self.base_trees))])
        return out

    def _features(self, width: int, seed: int) -> tuple[int, ...] | None:
        if self.feature_share >= 1.0 and not self.bootstrap_features:
            return None
        rng, k = random.Random(seed), max(1, int(self.feature_share * width))
        drawn = rng.choices(range(width), k=k) if self.bootstrap_features else rng.sample(range(width), k)
        return tuple(sorted(drawn))


_NAMES = {"n_estimators": "n_estimators", "max_depth": "max_depth", "min_samples_split": "min_samples_split",
          "min_samples_leaf": "min_samples_leaf", "max_features": "max_features", "bootstrap": "bootstrap",
          "max_samples": "max_samples"}


def forest_plan(candidate: dict) -> ForestPlan:
    """A random forest from its usual parameters."""
    return ForestPlan(**{_NAMES[k]: v for k, v in candidate.items()})


def bagging_plan(candidate: dict) -> ForestPlan:
    """A bag from its usual parameters; ``base_*`` go to the base. ``warm_start`` changes no single fit."""
    names = {"n_estimators": "n_estimators", "max_samples": "max_samples", "bootstrap": "bootstrap",
             "max_features": "feature_share", "bootstrap_features": "bootstrap_features",
             "base_estimator": "base", "base_max_depth": "max_depth", "base_trees": "base_trees",
             "base_min_samples_split": "min_samples_split", "base_min_samples_leaf": "min_samples_leaf"}
    return ForestPlan(**{names[k]: v for k, v in candidate.items() if k != "warm_start"})


class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    maxBins = Param(Params._dummy(), "maxBins", "different values or quantiles of a feature", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(maxBins=256, seed=0, featuresCol="features", labelCol="label", predictionCol="prediction")


class GrownForest(Estimator, _ForestParams):
    """Grows the trees of ``plan`` on a vector column."""

    def __init__(self, plan: ForestPlan | None = None, **params):
        super().__init__()
        self.plan = plan or ForestPlan()
        self._set_params(**params)

    @keyword_only
    def _set_params(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", maxBins=256, seed=0):
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> GrownForestModel:
        rows = binned(dataset, self.getFeaturesCol(), self.getLabelCol(), max_bins=self.getOrDefault(self.maxBins))
        model = GrownForestModel(grown_trees(rows, self.plan, self.getSeed()), self.plan)
        rows.drop()
        return self._copyValues(model)


def grown_trees(rows: Binned, plan: ForestPlan, seed: int) -> list[Tree]:
    members = plan.members(len(rows.edges), seed)
    return [t.tree() for t in grow(rows, [fit for member in members for fit in member])]


class GrownForestModel(Model, _ForestParams, StoredModel):
    """The mean of its trees (members of a bag hold equally many)."""

    def __init__(self, trees: list[Tree] | None = None, plan: ForestPlan | None = None):
        super().__init__()
        self.trees, self.plan = list(trees or []), plan

    def state(self) -> dict:
        return {"trees": [t.state() for t in self.trees], "plan": asdict(self.plan)}

    @classmethod
    def restored(cls, state: dict, parts: list) -> GrownForestModel:
        return cls([Tree(*t) for t in state["trees"]], ForestPlan(**state["plan"]))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.trees

        def mean(x):
            return sum(t.predict(x) for t in trees) / len(trees)

        return dataset.select(*dataset.columns, ensemble(self.getFeaturesCol(), mean).alias(self.getPredictionCol()))


def fold_scores(rows: Binned, cells: int, errors) -> np.ndarray:
    """R² of each cell on its held-out fold.

    ``errors(batch) -> [(cell, held, sum of squared errors)]`` runs in the tasks; one pass.
    """

    def run(batches):
        total = np.zeros(cells)
        for batch in batches:
            for cell, squares in errors(batch):
                total[cell] += squares
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["cell", "squares"])

    got = rows.df.mapInArrow(run, "cell long, squares double").groupBy("cell").agg(F.sum("squares").alias("squares"))
    squares = np.zeros(cells)
    for r in got.collect():
        squares[r["cell"]] = r["squares"]
    return squares


def fold_spread(rows: Binned) -> dict[int, float]:
    """Sum of squared deviations of the label from its mean in each fold."""
    got = rows.df.groupBy("fold").agg((F.var_pop("y") * F.count(F.lit(1))).alias("spread")).collect()
    return {r["fold"]: r["spread"] for r in got}


def r2(squares: float, spread: float) -> float:
    return 1.0 - squares / spread if spread else (1.0 if not squares else 0.0)


def forest_scores(rows: Binned, plans: list[ForestPlan], seed: int) -> list[float]:
    """Mean R² of each plan over the folds, all grown and scored in shared passes."""
    width = len(rows.edges)
    # Plans that differ only in the number of members are prefixes of the largest.
    groups: dict[ForestPlan, list[int]] = {}
    for k, plan in enumerate(plans):
        groups.setdefault(replace(plan, n_estimators=0), []).append(k)
    folds = sorted(rows.bounds)
    fits, block_of, blocks, cell = [], [], [], 0
    cells: dict[tuple[int, int], int] = {}
    for key, mine in groups.items():
        sizes = sorted({plans[k].n_estimators for k in mine})
        for held in folds:
            members = replace(key, n_estimators=sizes[-1]).members(width, seed, held)
            first = len(fits)
            fits += [fit for member in members for fit in member]
            block_of += [len(blocks)] * (len(fits) - first)
            blocks.append((first, [len(m) for m in members], {n: cell + i for i, n in enumerate(sizes)}))
            for k in mine:
                cells[k, held] = cell + sizes.index(plans[k].n_estimators)
            cell += len(sizes)
    spark = rows.df.sparkSession
    held, paths = held_out(rows, fits, block_of)
    shared = spark.sparkContext.broadcast(blocks)

    def errors(table: pa.Table) -> pa.Table:
        """Squares of a block's rows in one chunk, by number of members."""
        first, sizes, wanted = shared.value[table.column("block")[0].as_py()]
        table = table.sort_by("tree")
        number, place, value = (table.column(c).to_pylist() for c in ("tree", "place", "value"))
        y, total, member_sum = (np.zeros(CHUNK) for _ in range(3))
        here, at, squares = np.zeros(CHUNK, bool), 0, {}

        def add(tree: int, into: np.ndarray) -> None:
            nonlocal at
            while at < len(number) and number[at] == tree:
                spot = np.frombuffer(place[at], "<u2")
                into[spot] += np.frombuffer(value[at], "<f8")
                if tree < 0:
                    here[spot] = True
                at += 1

        add(-1, y)
        tree = first
        for member, size in enumerate(sizes, 1):
            member_sum[:] = 0.0
            for tree in range(tree, tree + size):
                add(tree, member_sum)
            tree += 1
            total += member_sum / size
            if member in wanted:
                squares[wanted[member]] = float(np.sum((y[here] - total[here] / member) ** 2))
        return pa.table({"cell": pa.array(list(squares), pa.int64()), "squares": pa.array(list(squares.values()), pa.float64())})

    squares = np.zeros(cell)
    for r in (held.groupBy("block", "chunk").applyInArrow(errors, "cell long, squares double")
              .groupBy("cell").agg(F.sum("squares").alias("squares")).collect()):
        squares[r["cell"]] = r["squares"]
    spread = fold_spread(rows)
    shared.unpersist()
    for path in paths:
        discard(spark, path)
    return [float(np.mean([r2(squares[cells[k, f]], spread[f]) for f in folds])) for k in range(len(plans))]


def search_forests(train: DataFrame, features: list[str], label: str, candidates: list[dict], to_plan,
                   fold_col: str = "fold", order: list[str] | None = None, seed: int = 0, max_bins: int = 256,
                   rows: Binned | None = None):
    """(pipeline model grown on all of ``train``, best candidate, mean R² of each candidate).

    ``rows``: those of ``train`` if they are binned already; they stay.
    """
    from pyspark.ml import PipelineModel

    plans = [to_plan(c) for c in candidates]
    stage = assembler(features)
    given, rows = rows, rows or binned(stage.transform(train), FEATURES, label, fold_col, order, max_bins)
    scores = forest_scores(rows, plans, seed)
    at = max(range(len(scores)), key=scores.__getitem__)
    whole = replace(rows, bounds={})
    model = GrownForestModel(grown_trees(whole, plans[at], seed), plans[at])
    model._set(featuresCol=FEATURES, labelCol=label)
    if given is None:
        rows.drop()
    return PipelineModel([stage, model]), dict(candidates[at], effective=asdict(plans[at])), scores
