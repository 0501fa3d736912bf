"""Hyper-parameter search with contiguous (unshuffled) folds.

Grids are written with sklearn-style names and values; a translator turns
each candidate into an MLlib param map. ``CrossValidator(foldCol=...)``
fits every (candidate, fold) as distributed Spark jobs, several candidates
at a time from driver threads (``parallelism``), scores with R², and refits
the best candidate on the whole training set. An estimator whose candidates
share work says so in its ``fitMultiple``.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.base import FEATURES, assembler, pipeline, spread


def expand_grid(grid: dict) -> list[dict]:
    """Every combination of a ``{name: [values]}`` grid, in grid order."""
    names = list(grid)
    return [dict(zip(names, combo)) for combo in itertools.product(*[grid[n] for n in names])]


def randint(low: int, high: int) -> tuple:
    """Integer-uniform draw on ``[low, high)`` for :func:`sample_candidates`."""
    return ("randint", int(low), int(high))


def _is_dist(v) -> bool:
    return isinstance(v, tuple) and len(v) == 3 and v[0] == "randint"


def sample_candidates(space: dict, n_iter: int, seed: int) -> list[dict]:
    """Seeded candidates from a search space.

    If every entry is a list, ``n_iter`` distinct grid points are drawn
    without replacement (all of them when the grid is smaller). Otherwise
    each candidate draws every entry independently: a list uniformly, a
    ``randint(lo, hi)`` uniformly on ``[lo, hi)``.
    """
    rng = random.Random(seed)
    if not any(_is_dist(v) for v in space.values()):
        grid = expand_grid(space)
        if n_iter >= len(grid):
            return grid
        return [grid[i] for i in sorted(rng.sample(range(len(grid)), n_iter))]
    out = []
    for _ in range(n_iter):
        cand = {}
        for name, v in space.items():
            cand[name] = rng.randrange(v[1], v[2]) if _is_dist(v) else rng.choice(list(v))
        out.append(cand)
    return out


def cross_validate(train: DataFrame, features: list[str], label: str, estimator,
                   candidates: list[dict], to_params: Callable[[object, dict], dict],
                   fold_col: str = "fold", k: int = 5, parallelism: int = 4,
                   seed: int = 0) -> tuple[CrossValidatorModel, dict, list[float]]:
    """Cross-validated search; returns (model refit on all of ``train``, best
    candidate, mean R² per candidate).

    Candidates that translate to the same parameters (values that MLlib does
    not tell apart) are fitted once and share their score. The best candidate
    has the parameters in effect added as ``effective``.

    The columns that the fits read are kept once, as vectors, and a fold is a
    filter on them; MLlib's own loop keeps every column of each fold apart,
    through a Python function on each row.
    """
    stage = assembler(features)
    translated = [to_params(estimator, c) for c in candidates] or [{}]
    keys = [tuple(sorted((p.name, str(v)) for p, v in m.items())) for m in translated]
    first = {k: i for i, k in reversed(list(enumerate(keys)))}
    maps = [translated[i] for i in sorted(first.values())]
    place = {keys[i]: n for n, i in enumerate(sorted(first.values()))}
    evaluator = RegressionEvaluator(labelCol=label, predictionCol=_pred_col(estimator),
                                    metricName="r2")
    weight = [estimator.getOrDefault("weightCol")] if estimator.hasParam("weightCol") and estimator.isSet("weightCol") else []
    rows = spread(stage.transform(train).select(*dict.fromkeys([FEATURES, label, fold_col, *weight]))).persist()
    try:
        counts = {r[0]: r[1] for r in rows.groupBy(fold_col).count().collect()}
        if outside := [f for f in counts if f is None or not 0 <= f < k]:
            raise ValueError(f"Fold number must be in range [0, {k}), but got {outside[0]}.")
        for fold in range(k):
            if sum(n for f, n in counts.items() if f != fold) == 0:
                raise ValueError(f"The training data at fold {fold} is empty.")
            if fold not in counts:
                raise ValueError(f"The validation data at fold {fold} is empty.")

        def fold_scores(fold: int) -> list[float]:
            training, validation = rows.where(F.col(fold_col) != fold), rows.where(F.col(fold_col) == fold)
            got = [0.0] * len(maps)
            for at, model in estimator.fitMultiple(training, maps):
                got[at] = evaluator.evaluate(model.transform(validation))
            return got

        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, k))) as pool:
            by_fold = np.array(list(pool.map(inheritable_thread_target(train.sparkSession)(fold_scores), range(k))))
        best_map = maps[int(np.argmax(by_fold.mean(axis=0)))]
        fitted = PipelineModel([stage, estimator.fit(rows, best_map)])
    finally:
        rows.unpersist()
    cv = CrossValidator(estimator=pipeline(features, estimator), estimatorParamMaps=maps, evaluator=evaluator,
                        numFolds=k, foldCol=fold_col, parallelism=parallelism, seed=seed)
    model = cv._copyValues(CrossValidatorModel(fitted, by_fold.mean(axis=0).tolist(), stdMetrics=by_fold.std(axis=0).tolist()))
    scores = [model.avgMetrics[place[k]] for k in keys]
    best = {}
    if candidates:
        at = max(range(len(scores)), key=scores.__getitem__)
        best = dict(candidates[at], effective={p.name: v for p, v in translated[at].items()})
    return model, best, scores


def _pred_col(est) -> str:
    return est.getOrDefault("predictionCol") if est.hasParam("predictionCol") else "prediction"


__all__ = ["expand_grid", "randint", "sample_candidates", "cross_validate", "FEATURES"]
