"""Physical-plan properties: partial aggregation before every shuffle on
data rows, pruned scans, no single-partition exchange on data paths."""
import datetime as dt

from pyspark.sql import functions as F

from helioframe.operators.ingest import dedup_first, files_to_load
from helioframe.operators.tagmeta import tag_overlap
from helioframe.operators.windowing import window_mean
from helioframe.sources.layout import TABLE_SCHEMA, with_bucket
from helioframe.sources.sinks import _merge, file_rank

SF = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _raw(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    return e.select(F.col("event_type").alias("kks"), F.to_date("ts").alias("date"),
                    F.col("ts").alias("time"), "value", "event_id", "user_id")


def test_window_mean_partial_then_one_hash_exchange(spark):
    p = plan(window_mean(_raw(spark), "1 minute"))
    assert "partial_avg" in p
    assert p.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = _raw(spark).where(F.col("kks") == "click").select("time", "value")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p


def test_dedup_and_upsert_merge_aggregate_map_side(spark):
    raw = _raw(spark)
    assert "partial_min_by" in plan(dedup_first(raw, ["user_id", "date"], "value", "event_id"))
    rows = raw.select(F.lit(1).alias("file_no"), F.col("user_id").cast("long").alias("block"),
                      F.col("event_id").cast("long").alias("rid"), "kks", "date", "time", "value")
    ranked = with_bucket(rows).withColumn("__r", file_rank())
    p = plan(_merge(ranked, ("kks", "date", "time")))
    assert "partial_max_by" in p and "SinglePartition" not in p
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p and p.count("HashAggregate") == 2


def test_file_rank_orders_files_then_values_then_lines(spark):
    rows = [(1, 0, 0, 5.0), (1, 10**13, 2**33 - 1, 6.0), (1, 0, 1, None), (10**11, 7, 0, None), (10**11, 10**13, 0, 2.0), (10**11, 10**13, 1, 3.0)]
    df = spark.createDataFrame(rows, "file_no long, block long, rid long, value double").withColumn("r", file_rank())
    assert [tuple(r)[:4] for r in df.orderBy(F.col("r").desc()).collect()] == [rows[4], rows[5], rows[3], rows[0], rows[1], rows[2]]
    assert df.where("r is null").count() == 0


def test_reconciliation_and_anti_join_dedup_first(spark):
    part = spark.read.parquet(f"{SF}/part.parquet")
    a = part.select(F.col("p_name").alias("kks"))
    b = part.select(F.concat_ws("_", "p_brand", "p_name").alias("kks"))
    p = plan(tag_overlap(a, b))
    assert "partial_count" in p
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    w = pages.select(F.col("url").alias("file"))
    l_ = pages.select(F.col("url").alias("path"))
    p = plan(files_to_load(w, l_))
    assert p.count("HashAggregate") >= 4          # both sides distinct, map-side first
