"""ε-insensitive support-vector regression with data-dependent kernel maps, many fits in shared passes.

Each fit minimises ``1/(2Cn) |w|² + 1/n Σ max(0, |y - w·φ(x) - b| - ε)`` over a
smoothed kink that narrows in stages (:mod:`helioframe.models.svr`), here by
Newton's method. A fit is a generator that asks for values, slopes and the
curvature at some points; the points of all fits (candidates, folds, and the
candidates on all rows) are evaluated in one pass, several step lengths of
each at once, so a grid costs about as many passes as its slowest fit.

The maps are ``linear``, ``poly`` (all monomials, exact) and for ``rbf`` the
Nyström map: with landmarks Z and the kernel K between them, eigen-decomposed
as U diag(λ) Uᵀ, φ(x) = k(x, Z) U / √λ over the λ that matter. It gives the
kernel exactly between landmarks; :func:`kernel_residual` says how much of it
is lost on average over all rows. Landmarks are at most ``landmarks`` rows,
those of the least hashes of their values: a bounded sample that does not
depend on the partitioning. With as many landmarks as different rows the
solution is that of the dual.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol,
                                     HasPredictionCol)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.base import FEATURES, assembler
from helioframe.models.persist import StoredModel
from helioframe.models.trees import ensemble
from helioframe.session import discard, materialize

#: Eigenvalues below this share of the greatest are left out.
RANK = 1e-7
#: Widths of the smoothed kink, in standard deviations of the label.
DELTAS = (0.3, 0.1, 0.03, 0.01, 0.004)
#: Step lengths tried in one pass.
REACHES = (1.0, 0.5, 0.25, 0.0625)
#: Rows whose distances to the landmarks are held at once: they stay in the processor's cache.
PART = 512


@dataclass(frozen=True)
class KernelMap:
    """A feature map: ``kind`` linear, poly or rbf."""

    kind: str
    gamma: float = 1.0
    degree: int = 3
    landmarks: tuple = ()
    project: tuple = ()

    @classmethod
    def nystrom(cls, gamma: float, landmarks: np.ndarray) -> KernelMap:
        inner = np.exp(-gamma * _distances(landmarks, landmarks))
        value, vector = np.linalg.eigh(inner)
        kept = value > RANK * value[-1]
        project = vector[:, kept] / np.sqrt(value[kept])
        return cls("rbf", gamma, landmarks=tuple(map(tuple, landmarks.tolist())), project=tuple(map(tuple, project.tolist())))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.kind == "linear":
            return x
        if self.kind == "poly":
            columns, own = [], np.ascontiguousarray(x.T)
            for picked in combinations_with_replacement(range(x.shape[1]), self.degree):
                ways = math.factorial(self.degree)
                for j in set(picked):
                    ways //= math.factorial(picked.count(j))
                product = own[picked[0]]
                for j in picked[1:]:
                    product = product * own[j]
                columns.append(math.sqrt(ways * self.gamma**self.degree) * product)
            return np.column_stack(columns)
        near, project = self._arrays
        out = np.empty((len(x), project.shape[1]))
        for i in range(0, len(x), PART):
            far = _distances(x[i:i + PART], near)
            far *= -self.gamma
            out[i:i + PART] = np.exp(far, out=far) @ project
        return out

    @cached_property
    def _arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.landmarks), np.array(self.project)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a * a).sum(1)[:, None] + (b * b).sum(1)
    out -= 2 * a @ b.T
    return np.maximum(out, 0.0, out=out)


@dataclass(frozen=True)
class Problem:
    """One fit: its map, fold left out, penalty and tube."""

    map: int
    held: int | None
    C: float
    epsilon: float


@dataclass
class Solution:
    weights: np.ndarray
    intercept: float
    objective: float
    converged: bool
    passes: int


@dataclass
class SvrRows:
    """``fold``, ``y`` and the features ``x`` as an array, written once."""

    df: DataFrame
    path: str
    width: int
    sums: dict = field(default_factory=dict)        # fold -> count, sums of entries and squares

    def gamma(self, rule, held: int | None) -> float:
        """``scale``: 1 / (features × variance of all entries), ``auto``: 1 / features, or the number."""
        if rule == "auto":
            return 1.0 / self.width
        if rule != "scale":
            return float(rule)
        n, one, two = (sum(v[k] for f, v in self.sums.items() if f != held) for k in range(3))
        n *= self.width
        spread = two / n - (one / n) ** 2
        return 1.0 / (self.width * spread) if spread > 0 else 1.0

    def drop(self) -> None:
        discard(self.df.sparkSession, self.path)


def svr_rows(df: DataFrame, features: str, label: str, fold: str | None = None) -> SvrRows:
    x = vector_to_array(F.col(features)).alias("x")
    rows, path = materialize(df.select((F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"),
                                       F.col(label).cast("double").alias("y"), x), "svr")
    one = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    two = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    got = rows.groupBy("fold").agg(F.count(F.lit(1)), F.sum(one), F.sum(two), F.max(F.size("x"))).collect()
    if not got:
        raise ValueError("no rows to fit")
    return SvrRows(rows, path, got[0][4], {r[0]: (r[1], r[2], r[3]) for r in got})


def chosen_landmarks(rows: SvrRows, most: int, held: int | None = None) -> np.ndarray:
    """At most ``most`` different rows, those of the least hashes of their values."""
    some = rows.df if held is None else rows.df.where(F.col("fold") != held)
    got = (some.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(int(most)).collect())
    return np.array([r["x"] for r in got])


def _moments(rows: SvrRows, maps: list[KernelMap]) -> dict:
    """(map, fold) -> rows, sums of the mapped features, of their squares, of the label and its square."""
    width = rows.width

    def run(batches):
        total: dict = {}
        for batch in batches:
            fold, y, x = _columns(batch, width)
            for number, m in enumerate(maps):
                z = m(x)
                for f in np.unique(fold):
                    at = fold == f
                    got = np.concatenate([[at.sum(), y[at].sum(), (y[at] ** 2).sum()], z[at].sum(0), (z[at] ** 2).sum(0)])
                    total[number, int(f)] = total.get((number, int(f)), 0.0) + got
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total]), pa.array([k[1] for k in total]),
                                              pa.array(list(total.values()), pa.list_(pa.float64()))], names=["map", "fold", "s"])

    def add(t: pa.Table) -> pa.Table:
        return pa.table({"map": [t.column("map")[0].as_py()], "fold": [t.column("fold")[0].as_py()],
                         "s": pa.array([np.sum(t.column("s").to_pylist(), axis=0)], pa.list_(pa.float64()))})

    schema = "map long, fold long, s array<double>"
    got = rows.df.mapInArrow(run, schema).groupBy("map", "fold").applyInArrow(add, schema).collect()
    return {(r["map"], r["fold"]): np.array(r["s"]) for r in got}


def _columns(batch, width: int):
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return (batch.column("fold").to_numpy(zero_copy_only=False), batch.column("y").to_numpy(zero_copy_only=False), x)


class _Scale:
    """Means and deviations of label and mapped features on the rows of a problem."""

    def __init__(self, problem: Problem, kind: str, moments: dict):
        s = sum(v for (m, f), v in moments.items() if m == problem.map and f != problem.held)
        self.n = float(s[0])
        size = (len(s) - 3) // 2
        self.ym = s[1] / self.n
        self.ysd = math.sqrt(max(s[2] / self.n - self.ym**2, 0.0)) or 1.0
        self.mu = s[3:3 + size] / self.n
        sd = np.sqrt(np.maximum(s[3 + size:] / self.n - self.mu**2, 0))
        sd[sd <= 1e-12 * np.maximum(np.abs(self.mu), 1)] = 1.0
        if kind == "rbf":
            # Directions of small eigenvalues stay small: they are the penalty's business.
            sd[:] = sd.max()
        self.sd = sd
        # Weights are those of standardised features, in units of the label's deviation.
        self.penalty = self.ysd / (problem.C * self.n) / sd**2
        self.eps = problem.epsilon / self.ysd


def _solve(scale: _Scale, most: int, tol: float) -> Iterator:
    """Newton's method as a generator.

    Yields (points, delta), is sent (value, slope, exact value) of each point
    and the curvature at the first; returns a Solution.
    """
    size = len(scale.mu)
    theta, passes, converged, exact = np.zeros(size + 1), 0, False, 0.0
    for delta in DELTAS:
        ((value, slope, exact),), curve = yield [theta], delta
        passes += 1
        converged = False
        while passes < most:
            if np.abs(slope).max() <= tol:
                converged = True
                break
            ridge = 1e-9 * max(float(np.trace(curve)) / (size + 1), 1e-9)
            way = -np.linalg.solve(curve + ridge * np.eye(size + 1), slope)
            down, reach, taken = float(slope @ way), 1.0, None
            while taken is None and passes < most and reach > 1e-10:
                points = [theta + reach * r * way for r in REACHES]
                got, curve = yield points, delta
                passes += 1
                taken = next((k for k, r in enumerate(REACHES) if got[k][0] <= value + 1e-4 * reach * r * down), None)
                reach *= REACHES[-1] / 2
            if taken is None:
                converged = passes < most            # no step lowers the value any more
                break
            # The value is known well enough; the last, narrowest stage is the one that counts.
            small = value - got[taken][0] <= (1e-8 if delta == DELTAS[-1] else 1e-4) * max(abs(value), 1e-9)
            theta, (value, slope, exact) = points[taken], got[taken]
            if small:
                converged = True
                break
            if taken and passes < most:
                (_,), curve = yield [theta], delta
                passes += 1
    v = theta[:size]
    return Solution(v * scale.ysd / scale.sd, float(scale.ym + scale.ysd * (theta[size] - v @ (scale.mu / scale.sd))),
                    float(exact * scale.ysd), bool(converged), passes)


def solve(rows: SvrRows, maps: list[KernelMap], problems: list[Problem], most: int = 200, tol: float = 1e-4) -> list[Solution]:
    """All problems in lockstep: one pass over the rows answers what every unfinished one asks."""
    moments = _moments(rows, maps)
    scales = [_Scale(p, maps[p.map].kind, moments) for p in problems]
    going = {k: _solve(s, most, tol) for k, s in enumerate(scales)}
    asked = {k: next(g) for k, g in going.items()}
    done: dict[int, Solution] = {}
    while asked:
        answers = _evaluated(rows, maps, problems, scales, asked)
        still = {}
        for k in asked:
            try:
                still[k] = going[k].send(answers[k])
            except StopIteration as end:
                done[k] = end.value
        asked = still
    return [done[k] for k in range(len(problems))]


def _evaluated(rows: SvrRows, maps, problems, scales, asked) -> dict:
    """Smoothed value, its slope, and the value with the kink, at every point asked for; the curvature at the first."""
    width = rows.width
    shared = rows.df.sparkSession.sparkContext.broadcast((maps, problems, scales, asked))

    def run(batches):
        maps, problems, scales, asked = shared.value
        total: dict = {}
        for batch in batches:
            fold, y, x = _columns(batch, width)
            alone = fold[0] if len(fold) and (fold == fold[0]).all() else None
            for number in sorted({problems[k].map for k in asked}):
                # Folds are runs of neighbouring rows: most batches are of one fold, in all of a problem or in none.
                mine = [k for k in asked if problems[k].map == number and (alone is None or problems[k].held != alone)]
                if not mine:
                    continue
                z = maps[number](x)
                for k in mine:
                    p, scale = problems[k], scales[k]
                    use = slice(None) if p.held is None or alone is not None else fold != p.held
                    zs, ys = (z[use] - scale.mu) / scale.sd, (y[use] - scale.ym) / scale.ysd
                    points, delta = asked[k]
                    theta = np.column_stack(points)
                    r = ys[:, None] - zs @ theta[:-1] - theta[-1]
                    over = np.maximum(np.abs(r) - scale.eps, 0)
                    soft = np.where(over < delta, over * over / (2 * delta), over - delta / 2)
                    slope = -np.sign(r) * np.minimum(over / delta, 1)
                    bent = zs[(over[:, 0] > 0) & (over[:, 0] < delta)]
                    bent = np.column_stack([bent, np.ones(len(bent))])
                    got = np.column_stack([over.sum(0), soft.sum(0), slope.sum(0), slope.T @ zs])
                    total[k] = total.get(k, 0.0) + np.concatenate([got.ravel(), (bent.T @ bent / delta).ravel()])
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()), pa.list_(pa.float64()))],
                                             names=["k", "s"])

    def add(t: pa.Table) -> pa.Table:
        return pa.table({"k": [t.column("k")[0].as_py()],
                         "s": pa.array([np.sum(t.column("s").to_pylist(), axis=0)], pa.list_(pa.float64()))})

    got = rows.df.mapInArrow(run, "k long, s array<double>").groupBy("k").applyInArrow(add, "k long, s array<double>").collect()
    shared.unpersist()
    out = {}
    for r in got:
        scale, (points, _) = scales[r["k"]], asked[r["k"]]
        size = len(scale.mu) + 1
        sums = np.array(r["s"]) / scale.n
        answers = []
        for theta, s in zip(points, sums[:len(points) * (size + 2)].reshape(len(points), -1)):
            v = theta[:-1]
            penalty = float(scale.penalty @ (v * v)) / 2
            answers.append((penalty + s[1], np.concatenate([scale.penalty * v + s[3:], [s[2]]]), penalty + s[0]))
        curve = sums[len(points) * (size + 2):].reshape(size, size) + np.diag(np.append(scale.penalty, 0.0))
        out[r["k"]] = answers, curve
    return out


def kernel_residual(df: DataFrame, features: str, gamma: float, landmarks: np.ndarray) -> DataFrame:
    """``(n, residual)``: the mean over all rows of k(x, x) - φ(x)·φ(x), 0 where the map is exact and 1 at most."""
    own = KernelMap.nystrom(gamma, np.asarray(landmarks, float))

    def lost(x):
        z = own(x)
        return 1.0 - (z * z).sum(axis=1)

    return df.select(ensemble(features, lost).alias("lost")).agg(F.count(F.lit(1)).alias("n"), F.avg("lost").alias("residual"))


class _KernelParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    kernel = Param(Params._dummy(), "kernel", "linear | poly | rbf", TypeConverters.toString)
    C = Param(Params._dummy(), "C", "penalty of the loss", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "'scale', 'auto' or a number", TypeConverters.toString)
    epsilon = Param(Params._dummy(), "epsilon", "half width of the tube", TypeConverters.toFloat)
    degree = Param(Params._dummy(), "degree", "of poly", TypeConverters.toInt)
    landmarks = Param(Params._dummy(), "landmarks", "rows of the Nyström map at most", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "passes at most", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "greatest slope at the solution", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(kernel="rbf", C=1.0, gamma="scale", epsilon=0.1, degree=3, landmarks=256, maxIter=200, tol=1e-4,
                         featuresCol="features", labelCol="label", predictionCol="prediction")


class KernelSVR(Estimator, _KernelParams):
    """One fit on all rows."""

    def __init__(self, **params):
        super().__init__()
        self._set(**{k: str(v) if k == "gamma" else v for k, v in params.items()})

    def _fit(self, dataset: DataFrame) -> KernelSVRModel:
        get = self.getOrDefault
        rows = svr_rows(dataset, self.getFeaturesCol(), self.getLabelCol())
        kind = get(self.kernel)
        own = _map(rows, kind, get(self.gamma), get(self.degree), None,
                   chosen_landmarks(rows, get(self.landmarks)) if kind == "rbf" else None)
        got, = solve(rows, [own], [Problem(0, None, get(self.C), get(self.epsilon))], get(self.maxIter), get(self.tol))
        rows.drop()
        return self._copyValues(KernelSVRModel(own, got))


def _map(rows: SvrRows, kind: str, gamma, degree: int, held: int | None, landmarks) -> KernelMap:
    if kind == "linear":
        return KernelMap("linear")
    g = rows.gamma(gamma, held)
    if kind == "poly":
        return KernelMap("poly", g, degree)
    if kind != "rbf":
        raise ValueError(f"unknown kernel {kind!r}")
    return KernelMap.nystrom(g, landmarks)


class KernelSVRModel(Model, _KernelParams, StoredModel):
    def __init__(self, own: KernelMap | None = None, solution: Solution | None = None):
        super().__init__()
        self.map, self.solution = own, solution

    objective = property(lambda self: self.solution.objective)
    converged = property(lambda self: self.solution.converged)
    passes = property(lambda self: self.solution.passes)

    def state(self) -> dict:
        m, s = self.map, self.solution
        return {"map": [m.kind, m.gamma, m.degree, m.landmarks, m.project],
                "solution": [s.weights.tolist(), s.intercept, s.objective, s.converged, s.passes]}

    @classmethod
    def restored(cls, state: dict, parts: list) -> KernelSVRModel:
        weights, *rest = state["solution"]
        return cls(KernelMap(*state["map"]), Solution(np.array(weights), *rest))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        own, s = self.map, self.solution
        return dataset.select(*dataset.columns, ensemble(self.getFeaturesCol(), lambda x: own(x) @ s.weights + s.intercept)
                              .alias(self.getPredictionCol()))


def search_svr(train: DataFrame, features: list[str], label: str, candidates: list[dict], fold_col: str = "fold",
               landmarks: int = 256, most: int = 200, tol: float = 1e-4):
    """(pipeline model on all of ``train``, best candidate, mean R² of each candidate), solved in lockstep.

    The best candidate says whether its solver ended by itself and after how
    many passes (``converged``, ``passes``).
    """
    stage = assembler(features)
    rows = svr_rows(stage.transform(train), FEATURES, label, fold_col)
    folds = sorted(rows.sums)
    maps: list[KernelMap] = []
    number: dict = {}
    points: dict = {}

    def map_of(c: dict, held: int | None) -> int:
        kind = c.get("kernel", "rbf")
        g = None if kind == "linear" else rows.gamma(c.get("gamma", "scale"), held)
        key = (kind, g, int(c.get("degree", 3)), held if kind == "rbf" else None)
        if key not in number:
            if kind == "rbf" and held not in points:
                points[held] = chosen_landmarks(rows, landmarks, held)
            number[key] = len(maps)
            maps.append(_map(rows, kind, g, key[2], held, points.get(held)))
        return number[key]

    problems, place = [], {}
    for k, c in enumerate(candidates):
        for held in [*folds, None]:
            p = Problem(map_of(c, held), held, float(c.get("C", 1.0)), float(c.get("epsilon", 0.1)))
            # Candidates that a kernel does not tell apart are one problem.
            if p not in place:
                place[p] = len(problems)
                problems.append(p)
            place[k, held] = place[p]
    solutions = solve(rows, maps, problems, most, tol)
    width = rows.width
    scored = sorted({place[k, held] for k in range(len(candidates)) for held in folds})
    shared = rows.df.sparkSession.sparkContext.broadcast((maps, problems, solutions, scored))

    def errors(batches):
        maps, problems, solutions, scored = shared.value
        total = np.zeros(len(problems))
        for batch in batches:
            fold, y, x = _columns(batch, width)
            for number in sorted({problems[k].map for k in scored}):
                if not np.isin(fold, [problems[k].held for k in scored if problems[k].map == number]).any():
                    continue
                z = maps[number](x)
                for k in scored:
                    if problems[k].map == number:
                        at = fold == problems[k].held
                        s = solutions[k]
                        total[k] += float(np.sum((y[at] - z[at] @ s.weights - s.intercept) ** 2))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(problems)), pa.int64()), pa.array(total)], names=["k", "squares"])

    squares = {r["k"]: r["s"] for r in rows.df.mapInArrow(errors, "k long, squares double")
               .groupBy("k").agg(F.sum("squares").alias("s")).collect()}
    spread = {r["fold"]: r["s"] for r in rows.df.groupBy("fold").agg((F.var_pop("y") * F.count(F.lit(1))).alias("s")).collect()}
    shared.unpersist()
    scores = [float(np.mean([1 - squares[place[k, held]] / spread[held] if spread[held] else 0.0 for held in folds]))
              for k in range(len(candidates))]
    at = max(range(len(scores)), key=scores.__getitem__)
    whole = problems[place[at, None]]
    model = KernelSVRModel(maps[whole.map], solutions[place[at, None]])
    model._set(featuresCol=FEATURES, labelCol=label)
    rows.drop()
    best = dict(candidates[at], converged=model.converged, passes=model.passes)
    return PipelineModel([stage, model]), best, scores
