"""CSV files -> raw table -> window means -> wide features -> models."""
import datetime as dt
import math
import os

from pyspark.sql import functions as F

from conftest import write_files
from helioframe.plans import aggregate_job
from helioframe.plans.feature_job import safe_name, wide_features
from helioframe.plans.ingest_job import ingest
from helioframe.plans.training_job import SearchConfig, train_all
from helioframe.sources.sinks import read_partitioned


def _csv(values):
    base = dt.datetime(2017, 3, 1)
    lines = []
    for i, v in enumerate(values):
        t = base + dt.timedelta(seconds=20 * i)
        lines.append(t.strftime("%d/%m/%Y %H:%M:%S") + ";" + f"{v:.4f}".replace(".", ","))
    return "\n".join(lines) + "\n"


def test_three_stages(spark, workdir):
    n = 3 * 240                                  # 4 hours of 20 s samples = 240 minutes
    xs = [math.sin(i / 50.0) for i in range(n)]
    zs = [math.cos(i / 70.0) for i in range(n)]
    ys = [0.3 + 0.05 * x * x + 0.02 * z for x, z in zip(xs, zs)]
    write_files(workdir + "/in", {"11CXA01.PV_Out#Value.csv": _csv(xs),
                                  "13WSX40 flow.csv": _csv(zs),
                                  "eficiencia.csv": _csv(ys)})
    res = ingest(spark, workdir + "/in", workdir + "/raw")
    assert {r.status for r in res.outcomes.collect()} == {"loaded"}
    tags = ["11CXA01.PV_Out#Value", "13WSX40 flow", "eficiencia"]
    agg = aggregate_job.run(spark, workdir + "/raw", workdir + "/agg", tags,
                            "2017-03-01T00:00:00", "2017-03-01T00:00:00")
    assert agg.count() == 3 * 240
    feats, names = wide_features(agg, tags)
    assert names["11CXA01.PV_Out#Value"] == safe_name("11CXA01.PV_Out#Value")
    assert feats.count() == 240
    cfg = SearchConfig(
        forest_space={"n_estimators": [10], "max_depth": [5], "max_features": ["auto"],
                      "min_samples_leaf": [2], "bootstrap": [True]}, forest_iter=1,
        svr_grid={"kernel": ["rbf"], "C": [1.0], "gamma": ["scale"], "epsilon": [0.01]},
        ada_grid={"n_estimators": [2], "learning_rate": [1.0]},
        bagging_space={"base_estimator": ["tree"], "n_estimators": [3], "bootstrap": [True],
                       "base_max_depth": [4], "base_min_samples_leaf": [2]},
        bagging_iter=1, folds=3, svr_max_iter=25, svr_landmarks=64)
    out = train_all(feats, names["eficiencia"], time="time", config=cfg)
    assert (out.n_rows, out.n_train) == (240, 192)
    m = {r.model: r.rmse for r in out.metrics.collect()}
    assert set(m) == {"media", "rl", "rf", "svr", "ada", "bagging"}
    assert all(v is not None and v >= 0 for v in m.values())
