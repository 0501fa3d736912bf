import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helioframe.operators import band, window_state as ws
from helioframe.operators.keyed import _days_and_buckets, read_by_keys
from helioframe.sources.layout import kks_bucket
from helioframe.sources.sinks import read_partitioned, upsert

SCHEMA = "kks string, time timestamp_ntz, value double"


def batch(spark, rows):
    df = spark.createDataFrame([(k, dt.datetime(2024, 1, d, 10, m, s), v) for k, d, m, s, v in rows], SCHEMA)
    return df.select("kks", F.to_date("time").alias("date"), "time", "value")


def got(spark, path):
    return {(r["kks"], r["time"]): r["value"] for r in ws.means(ws.read_states(spark, path)).collect()}


def expected(spark, raw):
    return {(r["kks"], r["time"]): r["value"] for r in ws.means(ws.window_states(read_partitioned(spark, raw))).collect()}


def same(a, b):
    def eq(x, y):
        return x == y or x is not None and y is not None and (abs(x - y) < 1e-9 or math.isnan(x) and math.isnan(y))
    return a.keys() == b.keys() and all(eq(a[k], b[k]) for k in a)


def test_loads_add_up(spark, workdir):
    raw, path = workdir + "/raw", workdir + "/states"
    loads = [
        [("a", 1, 0, 1, 1.0), ("a", 1, 0, 2, 3.0), ("b", 1, 0, 1, None), ("a", 2, 5, 0, 7.0)],
        [("a", 1, 0, 2, 3.0), ("a", 1, 0, 3, 8.0), ("b", 1, 0, 2, 4.0)],          # sent again, late, first number
        [("a", 1, 0, 1, 11.0), ("a", 1, 0, 9, 1.0), ("b", 3, 0, 0, math.nan)],     # corrected and late in one window
        [("b", 3, 0, 0, 2.0), ("b", 1, 0, 2, None)],                               # NaN and a number corrected
        [],
    ]
    for rows in loads:
        ws.load(batch(spark, rows), raw, path)
        assert same(got(spark, path), expected(spark, raw))
    final = got(spark, path)
    assert final["a", dt.datetime(2024, 1, 1, 10, 0)] == pytest.approx((11 + 3 + 8 + 1) / 4)
    assert final["b", dt.datetime(2024, 1, 1, 10, 0)] is None and final["b", dt.datetime(2024, 1, 3, 10, 0)] == 2.0


def test_plant_time_over_midnight(spark, workdir):
    raw, path = workdir + "/raw", workdir + "/states"
    def night(rows):
        df = spark.createDataFrame([("a", dt.datetime(2024, 1, 2, 0, m), v) for m, v in rows], SCHEMA)
        return df.select("kks", F.to_date("time").alias("date"), "time", "value")
    for rows in ([(10, 1.0), (20, 2.0)], [(10, 5.0), (30, 3.0)], [(40, 4.0)]):
        ws.load(night(rows), raw, path, "1 hour", "Europe/Madrid")
    assert got(spark, path) == {("a", dt.datetime(2024, 1, 1, 23, 0)): (5 + 2 + 3 + 4) / 4}


@pytest.mark.parametrize("after_upsert", [False, True])
def test_a_load_that_died(spark, workdir, after_upsert):
    raw, path = workdir + "/raw", workdir + "/states"
    ws.load(batch(spark, [("a", 1, 0, 1, 1.0)]), raw, path)
    second = batch(spark, [("a", 1, 0, 2, 3.0), ("a", 1, 1, 0, 9.0)])
    ws._write(ws.window_states(second.unionByName(batch(spark, [("a", 1, 0, 1, 1.0)]))), ws._staged(path))
    if after_upsert:
        upsert(second, raw)
    assert ws.recover_state(spark, raw, path, "1 minute", None) and not ws.recover_state(spark, raw, path, "1 minute", None)
    assert same(got(spark, path), expected(spark, raw))
    ws.load(second, raw, path)
    assert same(got(spark, path), expected(spark, raw)) and len(got(spark, path)) == 2


def test_band_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(t), "s", float(v)) for i, (t, v) in enumerate(zip(rng.integers(0, 4, 300), rng.normal(5, 2, 300)))]
    rows += [(1000, 9, "s", 2.5), (1001, 10, "s", None), (1002, 10, "s", None), (1003, 11, "s", 1.0), (1004, 11, "s", None)]
    df = spark.createDataFrame(rows, "id long, time long, series string, value double")
    out = {r["time"]: r for r in band.series_band(df.repartition(7), ["id"], replicates=200, seed=3).collect()}
    ids = {r["id"]: r["h"] for r in df.select("id", F.xxhash64("id").alias("h")).collect()}
    for t in range(4):
        mine = [(ids[i], v) for i, when, _, v in rows if when == t]
        w = band.weights(np.array([h for h, _ in mine]).view(np.uint64), 200, 3)
        drawn = np.array([v for _, v in mine]) @ w / w.sum(axis=0)
        low, high = np.percentile(drawn, [2.5, 97.5])
        assert out[t]["low"] == pytest.approx(low) and out[t]["high"] == pytest.approx(high) and low < out[t]["value"] < high
    assert (out[9]["low"], out[9]["value"], out[9]["high"]) == (2.5, 2.5, 2.5)
    assert (out[10]["n"], out[10]["low"], out[10]["value"]) == (0, None, None)
    assert (out[11]["n"], out[11]["low"], out[11]["high"]) == (1, 1.0, 1.0)
    assert band.series_band(df.limit(0), ["id"]).count() == 0


def test_poisson_weights():
    w = band.weights(np.arange(2000, dtype=np.uint64), 100, 0)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.03 and (w == 0).mean() == pytest.approx(math.exp(-1), abs=0.01)


def test_scattered_keys_read_their_folders_alone(spark, workdir):
    rows = [(f"t{k}", d, 0, 0, float(d)) for k in range(30) for d in range(1, 29)]
    upsert(batch(spark, rows), workdir + "/raw")
    raw = read_partitioned(spark, workdir + "/raw")
    keys = spark.createDataFrame([("t3", dt.datetime(2024, 1, 2)), ("t3", dt.datetime(2024, 1, 27)), ("t9", dt.datetime(2024, 1, 14))],
                                 "k string, d timestamp_ntz")
    found = read_by_keys(raw, keys, tz=None)
    assert sorted((r["kks"], r["value"]) for r in found.collect()) == [("t3", 2.0), ("t3", 27.0), ("t9", 14.0)]
    # Of 28 days times the buckets of 30 tags, the scan reads the folders of the keys alone.
    keyed = keys.select(F.to_date("d").alias("kd"), kks_bucket("k").alias("kb"))
    read = raw.where(_days_and_buckets(keyed))
    frame = read._jdf.queryExecution()
    frame.executedPlan().executeCollect()
    leaf = frame.executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numPartitions").value() == 3 < leaf.metrics().apply("numFiles").value() + 3
    assert read.select("date", "kks_bucket").distinct().count() == 3
