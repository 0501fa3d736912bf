"""Zone shifts, DST, day lists, key frames, tumbling windows, keyed reads."""
import datetime as dt
import math

from pyspark.sql import functions as F

from helioframe.functions.timefns import date_list, day_key, from_utc, ntz_lit, to_utc
from helioframe.operators.keyed import date_frame, key_frame, read_by_keys
from helioframe.operators.windowing import local_window_mean, window_mean, window_start
from helioframe.plans import aggregate_job
from helioframe.sources.sinks import read_partitioned, upsert

D = dt.datetime


def _df(spark, rows, schema="kks string, time timestamp_ntz, value double"):
    return spark.createDataFrame(rows, schema)


def test_spring_gap_and_autumn_overlap(spark):
    df = _df(spark, [("a", D(2017, 3, 26, 2, 30), 1.0), ("a", D(2017, 3, 26, 3, 30), 2.0),
                     ("a", D(2017, 10, 29, 2, 30), 3.0)])
    got = [(r.u, r.back) for r in df.select(to_utc("time").alias("u"))
           .select("u", from_utc("u").alias("back")).collect()]
    assert got == [(D(2017, 3, 26, 1, 30), D(2017, 3, 26, 3, 30)),
                   (D(2017, 3, 26, 1, 30), D(2017, 3, 26, 3, 30)),
                   (D(2017, 10, 29, 0, 30), D(2017, 10, 29, 2, 30))]


def test_spring_gap_merges_hours_in_the_local_pipeline(spark):
    df = _df(spark, [("a", D(2017, 3, 26, 2, 30), 1.0), ("a", D(2017, 3, 26, 3, 30), 3.0)])
    out = local_window_mean(df, "1 minute").collect()
    assert [(r.time, r.value) for r in out] == [(D(2017, 3, 26, 3, 30), 2.0)]


def test_window_edges(spark):
    df = _df(spark, [("a", D(2024, 1, 1, 0, 0, 0), 1.0),
                     ("a", D(2024, 1, 1, 0, 0, 59, 999000), 2.0),
                     ("a", D(2024, 1, 1, 0, 1, 0), 3.0)])
    out = window_start(window_mean(df, "1 minute")).orderBy("time").collect()
    assert [(r.time.minute, r.value) for r in out] == [(0, 1.5), (1, 3.0)]


def test_window_nulls_nan(spark):
    df = _df(spark, [("a", None, 1.0), ("a", D(2024, 1, 1, 0, 0), float("nan")),
                     ("a", D(2024, 1, 1, 0, 0, 5), 1.0), ("b", D(2024, 1, 1, 0, 0), None)])
    out = {r.kks: r.value for r in window_mean(df, "1 minute").collect()}
    assert math.isnan(out["a"]) and out["b"] is None
    assert window_mean(df, "1 minute").count() == 2      # null time dropped


def test_window_struct_and_all_numeric(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1, 0, 0), 1.0, 10)],
                               "kks string, time timestamp_ntz, value double, n int")
    r = window_mean(df, "1 hour", value=None).first()
    assert r.window.start == D(2024, 1, 1) and r.window.end == D(2024, 1, 1, 1)
    assert r["avg(value)"] == 1.0 and r["avg(n)"] == 10.0


def test_date_list_inclusive(spark):
    days = date_frame(spark, "2017-01-06T00:00:00", "2018-12-31T00:00:00")
    assert days.count() == 725
    ds = [r.d for r in days.orderBy("d").collect()]
    assert ds[0] == D(2017, 1, 6) and ds[-1] == D(2018, 12, 31)


def test_off_midnight_list_never_matches(spark):
    r = spark.range(1).select(F.explode(date_list("2017-01-06T06:00:00", "2017-01-08T06:00:00"))
                              .alias("d")).select(day_key("d").alias("k")).collect()
    assert [x.k for x in r] == [None, None, None]


def test_key_frame_and_pruned_keyed_read(spark, workdir):
    rows = [(t, D(2024, 1, d, 12), float(d)) for t in ("a", "b", "c") for d in range(1, 11)]
    raw = _df(spark, rows).withColumn("date", F.to_date("time"))
    upsert(raw, workdir + "/raw")
    table = read_partitioned(spark, workdir + "/raw")
    keys = key_frame(["a", "c"], "2024-01-03T00:00:00", "2024-01-05T00:00:00", spark)
    assert keys.count() == 6
    out = read_by_keys(table, keys)
    got = sorted((r.kks, r.date.day, r.time) for r in out.collect())
    assert len(got) == 6 and got[0] == ("a", 3, D(2024, 1, 3, 11))   # 12:00 CET -> 11:00 UTC
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "kks_bucket" in plan and "date" in plan


def test_aggregate_job_end_to_end(spark, workdir):
    rows = [("a", D(2024, 1, 1, 10, 0, 10), 1.0), ("a", D(2024, 1, 1, 10, 0, 20), 3.0),
            ("b", D(2024, 1, 2, 10, 5, 0), 5.0)]
    upsert(_df(spark, rows).withColumn("date", F.to_date("time")), workdir + "/raw")
    out = aggregate_job.run(spark, workdir + "/raw", workdir + "/agg", ["a", "b"],
                            "2024-01-01T00:00:00", "2024-01-02T00:00:00")
    got = sorted((r.kks, r.time, r.value) for r in out.collect())
    assert got == [("a", D(2024, 1, 1, 10, 0), 2.0), ("b", D(2024, 1, 2, 10, 5), 5.0)]
    # Running it again changes nothing (upsert on kks, date, time).
    out2 = aggregate_job.run(spark, workdir + "/raw", workdir + "/agg", ["a", "b"],
                             "2024-01-01T00:00:00", "2024-01-02T00:00:00")
    assert sorted((r.kks, r.time, r.value) for r in out2.collect()) == got


def test_aggregate_plan_has_no_sort_before_sink(spark, workdir):
    rows = [("a", D(2024, 1, 1, 10, 0, 10), 1.0)]
    upsert(_df(spark, rows).withColumn("date", F.to_date("time")), workdir + "/raw")
    keys = key_frame(["a"], "2024-01-01T00:00:00", "2024-01-01T00:00:00", spark)
    out = aggregate_job.aggregate_keys(read_partitioned(spark, workdir + "/raw"), keys)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "SortMergeJoin" not in plan


def test_ntz_literal(spark):
    assert spark.range(1).select(ntz_lit("2017-08-08 12:00")).first()[0] == D(2017, 8, 8, 12)
