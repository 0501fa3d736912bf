"""Key frames and keyed reads of the raw table (tags x days).

A key frame lists ``(k, d)`` pairs: a tag and the instant that names a day.
Reading by keys is an inner join on ``(kks, date)``; so that Parquet files
are pruned, static bounds taken from the keys (first/last day, tag buckets, the
buckets of each day while there are few days, and the tag list while it is
short; files carry a Bloom filter of their tags) are added as filters before the exact
join. The key frame is written once as a table, so its size is known and
Spark broadcasts it only below its threshold.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.functions.timefns import PLANT_TZ, date_list, day_key, to_utc
from helioframe.session import materialize
from helioframe.sources.layout import KKS_BUCKETS, kks_bucket

# Tag lists up to this length also become an IN filter on the tag (row groups).
MAX_PRUNING_TAGS = 10_000


# Up to so many days, the buckets of each are told apart (directories between scattered keys are not read).
MAX_PRUNING_DAYS = 1_000


def _days_and_buckets(k: DataFrame):
    """The directories that hold the keys, as one condition; days with the same buckets are put together."""
    by_day = k.groupBy("kd").agg(F.sort_array(F.collect_set("kb")).alias("kbs"))
    groups = by_day.groupBy("kbs").agg(F.sort_array(F.collect_list("kd")).alias("kds")).collect()
    parts = [F.col("date").isin(g["kds"]) & F.col("kks_bucket").isin(g["kbs"]) for g in groups]
    return reduce(or_, parts)


def date_frame(spark: SparkSession, start, end) -> DataFrame:
    """One row per instant of the inclusive day list: column ``d``."""
    return spark.range(1).select(F.explode(date_list(start, end)).alias("d"))


def key_frame(tags, start, end, spark: SparkSession | None = None,
              tag_col: str = "kks") -> DataFrame:
    """Tags x inclusive day list -> ``(k string, d timestamp_ntz)``.

    ``tags`` is a DataFrame with a tag column or a Python list. Each tag row
    explodes its own day list, so no cartesian product is planned.
    """
    if not isinstance(tags, DataFrame):
        spark = spark or SparkSession.getActiveSession()
        tags = spark.createDataFrame([(t,) for t in tags], f"{tag_col} string")
    return tags.select(F.col(tag_col).cast("string").alias("k"),
                       F.explode(date_list(start, end)).alias("d"))


def read_by_keys(raw: DataFrame, keys: DataFrame, tz: str | None = PLANT_TZ,
                 buckets: int = KKS_BUCKETS) -> DataFrame:
    """Rows of ``raw`` (kks, date, time, value) whose (kks, date) is in ``keys``.

    Times are shifted from plant wall time to UTC when ``tz`` is given, and
    the result is ``kks, date, time, value`` (``date`` is not shifted).
    ``buckets`` is the bucket count of the table ``raw`` is read from.
    """
    k = keys.select(F.col("k"), day_key("d").alias("kd")).where("kd IS NOT NULL").distinct()
    k, _ = materialize(k.withColumn("kb", kks_bucket("k", buckets)), "key-frame")
    # One aggregate for the static bounds; bucket numbers are at most the bucket count.
    lo, hi, n_tags, numbers, n_days = k.agg(F.min("kd"), F.max("kd"), F.count_distinct("k"),
                                            F.collect_set("kb"), F.count_distinct("kd")).first()
    pruned = raw
    if lo is None:               # no key names a day: nothing can match
        pruned = raw.limit(0)
    else:
        pruned = pruned.where(F.col("date").between(F.lit(lo), F.lit(hi)))
        if "kks_bucket" in raw.columns:
            pruned = pruned.where(F.col("kks_bucket").isin(numbers))
        if "kks_bucket" in raw.columns and n_days <= MAX_PRUNING_DAYS:
            pruned = pruned.where(_days_and_buckets(k))
        if n_tags <= MAX_PRUNING_TAGS:   # else too many for a literal list; the join stays exact
            pruned = pruned.where(F.col("kks").isin([r[0] for r in k.select("k").distinct().collect()]))
    joined = pruned.join(k, (pruned["kks"] == k["k"]) & (pruned["date"] == k["kd"]), "inner")
    t = to_utc("time", tz) if tz else F.col("time")
    return joined.select("kks", "date", t.alias("time"), "value")
