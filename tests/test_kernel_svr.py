"""Kernel SVR against the dual solution and single fits."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from helioframe.models import kernel_svr as ks


def frame(spark, x, y, fold=None):
    rows = [(i, [float(v) for v in a], float(b), int(fold[i]) if fold is not None else 0) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a array<double>, y double, fold int")
    return df.select("id", "fold", "y", array_to_vector("a").alias("v"), *[df["a"][k].alias(f"x{k}") for k in range(len(x[0]))])


def dual(x, y, gamma, c, eps, rounds=200_000):
    """The kernel solution at the rows, by steps on the pair that violates the dual's conditions most."""
    k = np.exp(-gamma * ks._distances(x, x))
    beta, f = np.zeros(len(y)), np.zeros(len(y))
    for _ in range(rounds):
        g = f - y
        up = np.where(beta < c, g + np.where(beta >= 0, eps, -eps), np.inf)
        down = np.where(beta > -c, g + np.where(beta > 0, eps, -eps), -np.inf)
        i, j = int(up.argmin()), int(down.argmax())
        if down[j] - up[i] < 1e-6:
            break
        most = min(-beta[i] if beta[i] < 0 else c - beta[i], beta[j] if beta[j] > 0 else c + beta[j])
        step = min((down[j] - up[i]) / (k[i, i] + k[j, j] - 2 * k[i, j] + 1e-12), most)
        beta[i] += step
        beta[j] -= step
        f += step * (k[:, i] - k[:, j])
    return f - (down[j] + up[i]) / 2


@pytest.fixture(scope="module")
def waves():
    rng = np.random.default_rng(3)
    x = rng.uniform(-2, 2, (500, 2))
    y = np.sin(2 * x[:, 0]) + 0.4 * x[:, 1] ** 2 + rng.normal(0, 0.05, 500)
    return x, y


def test_near_the_dual(spark, waves):
    x, y = waves
    want = dual(x, y, 0.5, 1.0, 0.05)
    df = frame(spark, x, y)
    for landmarks in (150,):
        m = ks.KernelSVR(featuresCol="v", labelCol="y", gamma=0.5, epsilon=0.05, landmarks=landmarks).fit(df)
        assert m.converged
        got = np.array([r["prediction"] for r in m.transform(df).orderBy("id").collect()])
        assert np.abs(got - want).mean() < 0.02 * np.abs(want - want.mean()).mean()


def test_residual(spark, waves):
    x, y = waves
    df = frame(spark, x, y)
    left = [ks.kernel_residual(df, "v", 0.5, x[:n]).first()["residual"] for n in (1, 5, 50, 500)]
    assert 1 > left[0] > left[1] > left[2] > left[3] and abs(left[3]) < 1e-6
    assert left[0] == pytest.approx(np.mean(1 - np.exp(-0.5 * ks._distances(x, x[:1])) ** 2))


def test_search_equals_single_fits(spark, waves):
    x, y = waves
    fold = np.arange(500) % 3
    df = frame(spark, x, y, fold)
    cands = [{"kernel": "linear", "C": 1.0}, {"kernel": "linear", "C": 1.0, "gamma": 0.1}, {"kernel": "poly", "C": 0.5, "gamma": "auto"},
             {"kernel": "rbf", "C": 1.0, "gamma": "scale"}, {"kernel": "rbf", "C": 10.0, "gamma": 0.5}]
    model, best, scores = ks.search_svr(df, ["x0", "x1"], "y", cands, landmarks=40)
    assert scores[0] == scores[1] and best["converged"] and best["passes"] > 3
    assert scores.index(max(scores)) >= 3
    for k in (0, 2, 4):
        c = dict(cands[k])
        kind = c.pop("kernel")
        parts = []
        for held in range(3):
            m = ks.KernelSVR(featuresCol="v", labelCol="y", kernel=kind, landmarks=40, **c).fit(df.where(f"fold <> {held}"))
            p = m.transform(df.where(f"fold = {held}")).select("y", "prediction").toPandas()
            parts.append(1 - ((p.y - p.prediction) ** 2).sum() / ((p.y - p.y.mean()) ** 2).sum())
        assert scores[k] == pytest.approx(np.mean(parts), abs=2e-4)
    got = model.transform(df)
    assert got.count() == 500 and model.stages[-1].converged


def test_stored(spark, waves, workdir):
    x, y = waves
    df = frame(spark, x, y)
    m = ks.KernelSVR(featuresCol="v", labelCol="y", landmarks=10, maxIter=20).fit(df)
    m.write().overwrite().save(workdir + "/svr")
    again = ks.KernelSVRModel.load(workdir + "/svr")
    assert [r[0] for r in again.transform(df).orderBy("id").select("prediction").collect()] == \
        [r[0] for r in m.transform(df).orderBy("id").select("prediction").collect()]
    assert (again.objective, again.converged, again.passes) == (m.objective, m.converged, m.passes)


def test_odd_input(spark):
    with pytest.raises(ValueError, match="no rows"):
        ks.svr_rows(frame(spark, [[1.0]], [1.0]).limit(0), "v", "y")
    constant = ks.KernelSVR(featuresCol="v", labelCol="y", kernel="linear").fit(frame(spark, [[1.0]] * 5, [2.0] * 5))
    assert abs(constant.solution.intercept - 2) < 0.2
    with pytest.raises(ValueError, match="unknown kernel"):
        ks.KernelSVR(featuresCol="v", labelCol="y", kernel="other").fit(frame(spark, [[1.0], [2.0]], [1.0, 2.0]))
