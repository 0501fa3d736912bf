"""ε-insensitive support-vector regression, solved in the primal on Spark.

MLlib has no SVR. This estimator minimises

    1/(2 C n) |w|^2 + 1/n * sum_i max(0, |y_i - w.phi(x_i) - b| - eps)

by L-BFGS. The kink of the loss is smoothed by a quadratic of width delta,
which is narrowed in three stages, each starting where the last one ended.
An evaluation is ONE pass over the mapped rows: NumPy on Arrow batches gives a
row of sums for each partition, and Spark adds these up. A stage ends when its
gradient is small (``tol``) or no step lowers the value; ``objective``,
``converged`` and ``passes`` of the model say how it went. The features are
written once, many rows' bytes in one row, so that a pass moves few values
from Parquet to NumPy; kernels become explicit feature maps, computed in each
pass on parts of rows that stay in the processor's cache:

* ``linear``: phi(x) = x;
* ``poly``:   the monomials of degree ``degree`` (kernel (gamma x.x')^degree),
  each times the root of gamma^degree and its multinomial coefficient;
* ``rbf``:    random Fourier features sqrt(2/D) cos(Ω x + u), Ω ~ N(0, 2γ),
  u ~ U[0, 2π) (Rahimi & Recht, 2007).

``gamma``: ``'scale'`` = 1 / (n_features * var(X)), ``'auto'`` =
1 / n_features, or a number. The solver works on the label and mapped
features standardised on the training rows, but penalises the weights of
the features as they are, so ``C`` means the same for every kernel and
scale. ``linear`` and ``poly`` are exact maps; ``rbf`` approximates the dual
(kernel) solution.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter,
                                     HasPredictionCol, HasSeed, HasTol)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.kernel_svr import KernelMap
from helioframe.models.persist import StoredModel
from helioframe.models.trees import ensemble
from helioframe.session import discard, ensure_checkpoint_dir, materialize

# Widths of the smoothed kink, in standard deviations of the label.
DELTAS = (0.1, 0.01, 0.001)
MEMORY = 10
#: Bytes of features and labels in a row of the packed table, and rows mapped at once.
PACKED, PART = 8192, 2048


class _SVRParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed, HasMaxIter, HasTol):
    kernel = Param(Params._dummy(), "kernel", "linear | poly | rbf", TypeConverters.toString)
    C = Param(Params._dummy(), "C", "penalty of the ε-insensitive loss", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "'scale', 'auto' or a number",
                  TypeConverters.toString)
    epsilon = Param(Params._dummy(), "epsilon", "half width of the tube", TypeConverters.toFloat)
    degree = Param(Params._dummy(), "degree", "poly degree", TypeConverters.toInt)
    nComponents = Param(Params._dummy(), "nComponents", "random features for rbf",
                        TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(kernel="rbf", C=1.0, gamma="scale", epsilon=0.1, degree=3,
                         nComponents=100, maxIter=200, tol=1e-4, seed=0,
                         featuresCol="features", labelCol="label", predictionCol="prediction")


def _mapped(x: np.ndarray, kernel: str, degree: int, gamma: float, omega, u) -> np.ndarray:
    """The feature map of the rows of a matrix."""
    if kernel != "rbf":
        return KernelMap(kernel, gamma, degree)(x)
    return np.cos(x @ np.array(omega).T + np.array(u)) * math.sqrt(2.0 / len(u))


def _packed(rows: DataFrame, p: int) -> DataFrame:
    """``(x, y)``: features (an array) and labels of neighbouring rows as bytes, some ``PACKED`` in all."""
    step = max(1, PACKED // (8 * (p + 1)))

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p).astype("<f8")
            y = batch.column("y").to_numpy(zero_copy_only=False).astype("<f8")
            at = range(0, len(y), step)
            yield pa.RecordBatch.from_arrays([pa.array([v[i:i + step].tobytes() for i in at], pa.binary()) for v in (x, y)],
                                             names=["x", "y"])

    return rows.mapInArrow(run, "x binary, y binary")


def _sums(rows: DataFrame, p: int, phi, per_part) -> np.ndarray:
    """Sum over all packed rows of ``per_part(Z, y) -> vector``: a row a partition, added up by Spark."""

    def run(batches):
        total = None
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<f8") for c in ("x", "y"))
            x = x.reshape(-1, p)
            for i in range(0, len(y), PART):
                got = per_part(phi(x[i:i + PART]), y[i:i + PART])
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["s"])

    n = len(per_part(phi(np.zeros((1, p))), np.zeros(1)))
    got = rows.mapInArrow(run, "s array<double>").agg(*[F.sum(F.col("s")[k]) for k in range(n)]).first()
    return np.array([v or 0.0 for v in got])


class EpsilonSVR(Estimator, _SVRParams):
    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction",
                 kernel="rbf", C=1.0, gamma="scale", epsilon=0.1, degree=3, nComponents=100,
                 maxIter=200, tol=1e-4, seed=0):
        super().__init__()
        self._set(**{k: (str(v) if k == "gamma" else v) for k, v in self._input_kwargs.items()})

    def _fit(self, dataset: DataFrame) -> EpsilonSVRModel:
        spark = dataset.sparkSession
        ensure_checkpoint_dir(spark)
        get = self.getOrDefault
        fc, kernel, degree = get(self.featuresCol), get(self.kernel), get(self.degree)
        base = dataset.select(F.col(fc), F.col(get(self.labelCol)).cast("double").alias("y"))
        p = len(base.first()[0])
        rows, path = materialize(_packed(base.select(vector_to_array(F.col(fc)).alias("x"), "y"), p), "svr-rows")
        # Label moments and the variance of all feature entries; a null label is in no moment.
        n, known, sy, sx, sxx = _sums(rows, p, np.asarray, lambda z, y: np.array(
            [len(y), np.count_nonzero(~np.isnan(y)), np.nansum(y), z.sum(), (z * z).sum()]))
        ym = sy / known
        ysd = math.sqrt(_sums(rows, p, np.asarray, lambda z, y: np.array([np.nansum((y - ym) ** 2)]))[0] / known) or 1.0
        var_x = sxx / (n * p) - (sx / (n * p)) ** 2
        g = get(self.gamma)
        gamma = (1.0 / (p * var_x) if var_x > 0 else 1.0) if g == "scale" else 1.0 / p if g == "auto" else float(g)
        rng = np.random.default_rng(get(self.seed))
        d = get(self.nComponents)
        omega = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(d, p)).tolist() if kernel == "rbf" else None
        u = rng.uniform(0.0, 2 * math.pi, size=d).tolist() if kernel == "rbf" else None

        def phi(rows_of_x):
            return _mapped(rows_of_x, kernel, degree, gamma, omega, u)

        m = phi(np.zeros((1, p))).shape[1]
        moments = _sums(rows, p, phi, lambda z, y: np.concatenate([z.sum(axis=0), (z * z).sum(axis=0)]))
        mu = moments[:m] / n
        sd = np.sqrt(np.maximum(moments[m:] / n - mu * mu, 0))
        sd[sd <= 1e-12 * np.maximum(np.abs(mu), 1)] = 1.0
        # In units of the label's standard deviation, with weights v of the standardised features:
        # w = v * ysd / sd, so the penalty |w|^2 / (2 C n) becomes v^2 / sd^2 * ysd / (2 C n).
        weight = ysd / (get(self.C) * n) / sd**2
        eps = get(self.epsilon) / ysd

        def evaluated(theta: np.ndarray, delta: float) -> tuple[float, np.ndarray, float]:
            """Smoothed value, its gradient, and the value with the kink."""
            v, b = theta[:m], theta[m]

            def per_part(z, y):
                zs = (z - mu) / sd
                r = (y - ym) / ysd - zs @ v - b
                over = np.maximum(np.abs(r) - eps, 0)
                soft = np.where(over < delta, over * over / (2 * delta), over - delta / 2)
                slope = -np.sign(r) * np.minimum(over / delta, 1)
                return np.concatenate([[over.sum(), soft.sum(), slope.sum()], slope @ zs])

            t = _sums(rows, p, phi, per_part) / n
            penalty = float(weight @ (v * v)) / 2
            return penalty + t[1], np.concatenate([weight * v + t[3:], [t[2]]]), penalty + t[0]

        theta, passes, converged, exact = np.zeros(m + 1), 0, False, 0.0
        most = get(self.maxIter)
        for delta in DELTAS:
            value, slope, exact = evaluated(theta, delta)
            passes += 1
            steps: list[tuple[np.ndarray, np.ndarray]] = []
            converged = False
            while passes < most:
                if np.abs(slope).max() <= get(self.tol):
                    converged = True
                    break
                way = -_inverse_hessian(steps, slope)
                reach, down = 1.0 if steps else min(1.0, 1.0 / np.abs(slope).sum()), float(slope @ way)
                moved = False
                while passes < most and reach > 1e-10:
                    at = theta + reach * way
                    got = evaluated(at, delta)
                    passes += 1
                    if got[0] <= value + 1e-4 * reach * down:
                        moved = True
                        break
                    reach /= 2 if steps else 4
                if not moved:
                    converged = passes < most  # no step lowers the value any more
                    break
                small = value - got[0] <= 1e-9 * max(abs(value), 1e-9)
                s, y = at - theta, got[1] - slope
                if s @ y > 1e-14:
                    steps = [*steps[-MEMORY + 1:], (s, y)]
                theta, (value, slope, exact) = at, got
                if small:
                    converged = True
                    break
        discard(spark, path)
        model = EpsilonSVRModel({
            "kernel": kernel, "p": p, "degree": degree, "gamma": gamma, "omega": omega, "u": u,
            "weights": (theta[:m] * ysd / sd).tolist(), "intercept": float(ym + ysd * (theta[m] - theta[:m] @ (mu / sd))),
            "objective": float(exact * ysd), "converged": bool(converged), "passes": passes})
        return self._copyValues(model)


def _inverse_hessian(steps: list[tuple[np.ndarray, np.ndarray]], slope: np.ndarray) -> np.ndarray:
    """The L-BFGS estimate of the inverse Hessian times the gradient."""
    q, factors = slope.copy(), []
    for s, y in reversed(steps):
        a = s @ q / (s @ y)
        factors.append(a)
        q = q - a * y
    if steps:
        s, y = steps[-1]
        q = q * (s @ y) / (y @ y)
    for (s, y), a in zip(steps, reversed(factors), strict=True):
        q = q + s * (a - y @ q / (s @ y))
    return q


class EpsilonSVRModel(Model, _SVRParams, StoredModel):
    def __init__(self, state: dict | None = None):
        super().__init__()
        self._state = state or {}

    #: Value of the stated objective at the solution, whether the solver ended by itself, passes over the rows.
    objective = property(lambda self: self._state["objective"])
    converged = property(lambda self: self._state["converged"])
    passes = property(lambda self: self._state["passes"])
    weights = property(lambda self: np.array(self._state["weights"]))
    intercept = property(lambda self: self._state["intercept"])

    def state(self) -> dict:
        return self._state

    @classmethod
    def restored(cls, state: dict, parts: list) -> EpsilonSVRModel:
        return cls(state)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        t, weights = self._state, np.array(self._state["weights"])

        def predicted(x):
            parts = [_mapped(x[i:i + PART], t["kernel"], t["degree"], t["gamma"], t["omega"], t["u"]) @ weights
                     for i in range(0, len(x), PART)]
            return np.concatenate(parts) + t["intercept"]

        return dataset.select(*dataset.columns, ensemble(self.getFeaturesCol(), predicted).alias(self.getPredictionCol()))
