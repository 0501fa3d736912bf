"""Raw table -> per-sensor window means, all sensors in one plan.

keyed read (tags x days, partition-pruned) -> plant time to UTC ->
tumbling-window mean per (kks, window) -> window start back to plant time
-> latest-wins upsert into the aggregate table (date / tag-bucket layout).

One action writes the result; there is no preview action and no sort
before the sink, so the raw partitions are read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.functions.timefns import PLANT_TZ, from_utc
from helioframe.operators.keyed import key_frame, read_by_keys
from helioframe.operators.windowing import window_mean
from helioframe.sources.layout import KKS_BUCKETS, table_buckets
from helioframe.sources.sinks import read_partitioned, upsert


def aggregate_keys(raw: DataFrame, keys: DataFrame, duration: str = "1 minute",
                   tz: str = PLANT_TZ, buckets: int = KKS_BUCKETS) -> DataFrame:
    """Window means of the keyed rows: ``kks, date, time`` (plant time), ``value``."""
    utc = read_by_keys(raw, keys, tz, buckets)
    agg = window_mean(utc, duration)
    local = from_utc(F.col("window.start"), tz)
    return agg.select("kks", F.to_date(local).alias("date"), local.alias("time"), "value")


def run(spark: SparkSession, raw_table: str, agg_table: str, tags, start: str, end: str,
        duration: str = "1 minute", tz: str = PLANT_TZ) -> DataFrame:
    """Aggregate ``tags`` over the inclusive days ``start``..``end`` and upsert."""
    raw = read_partitioned(spark, raw_table)
    keys = key_frame(tags, start, end, spark)
    out = aggregate_keys(raw, keys, duration, tz, table_buckets(spark, raw_table))
    # Window means are few next to the raw rows: one folder a day. An existing
    # table's upsert writes them once instead of aggregating twice.
    upsert(out, agg_table, buckets=1)
    return read_partitioned(spark, agg_table)
