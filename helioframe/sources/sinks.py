"""Sinks: latest-wins upsert into the plant tables, and manifests.

Writing a row whose key already exists replaces it (upsert), so loading the
same input twice leaves a table unchanged. On plain Parquet this is done as

1. the (date, kks_bucket) directories the batch touches stay a DataFrame;
   their distinct days and bucket numbers (bounded by the calendar and the
   bucket count) prune the table's directories, and a semi-join on the pairs
   leaves exactly the touched ones;
2. old and new rows are merged per key in one hash aggregate: the row of the
   greatest rank wins, and stored rows rank below every batch row;
3. the merge is written to a staged table beside the target. Only when it is
   complete (its ``_SUCCESS`` marker is there) are the touched directories
   replaced from it, and it is deleted after that. A job that dies while
   replacing leaves the staged table: :func:`recover`, which every upsert
   runs first, replaces again from it, so no stored row is lost.

``REBALANCE(date, kks_bucket)`` sends each directory to one task; AQE
splits a hot one over several tasks (files) and packs small ones. Rows are
sorted by (kks, time) inside files so Parquet row-group statistics prune
by tag.
See :mod:`helioframe.sources.layout`.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from helioframe.session import discard, materialize
from helioframe.sources.layout import (CLUSTER_COLS, KKS_BUCKETS, PARTITION_COLS,
                                       TABLE_SCHEMA, set_buckets,
                                       table_buckets, with_bucket)

# Ranks are fixed-width numbers, so that the merge is a hash aggregate.
RANK = DecimalType(38, 0)


def _power(n: int) -> Column:
    return F.lit(Decimal(10**n)).cast(RANK)


def file_rank(file_no: str = "file_no", block: str = "block", rid: str = "rid", value: str = "value") -> Column:
    """Rank of a row among those of its key: the last file wins (``file_no``
    orders the files, below 1e12), and within a file the first row with a
    value, in the order of the lines (start byte of the split, below 1e14,
    then row id within it, below 1e10)."""
    in_split = F.col(rid).bitwiseAND(F.lit((1 << 33) - 1)).cast(RANK)
    place = (F.col(block).cast(RANK) * _power(10) + in_split).cast(RANK)
    filled = F.when(F.col(value).isNotNull(), _power(25)).otherwise(F.lit(0).cast(RANK))
    return ((F.col(file_no).cast(RANK) * _power(26)).cast(RANK) + filled + (_power(25) - place).cast(RANK)).cast(RANK)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds table data (a partition folder or data file).

    A dynamic partition overwrite commits only partition folders (its
    ``_SUCCESS`` marker stays in Spark's staging area), so the marker cannot
    be used; hidden entries (``_*``, ``.*``) are ignored.
    """
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return False
    for st in fs.listStatus(jpath):
        name = st.getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def read_partitioned(spark: SparkSession, path: str,
                     schema: StructType = TABLE_SCHEMA) -> DataFrame:
    """Read a plant table with declared types (partition values included)."""
    return spark.read.schema(schema).parquet(path)


#: A Bloom filter of each file's tags, so that a read of few tags skips row groups without them.
BLOOM = {"parquet.bloom.filter.enabled#kks": "true", "parquet.bloom.filter.expected.ndv#kks": "10000"}


def _write(df: DataFrame, path: str) -> None:
    (df.hint("rebalance", *PARTITION_COLS)
       .sortWithinPartitions(*PARTITION_COLS, *CLUSTER_COLS)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").options(**BLOOM)
       .partitionBy(*PARTITION_COLS)
       .parquet(path))


def staged_path(path: str) -> str:
    return f"{path.rstrip('/')}.staged"


def _stage(df: DataFrame, path: str) -> None:
    (df.hint("rebalance", *PARTITION_COLS)
       .sortWithinPartitions(*PARTITION_COLS, *CLUSTER_COLS)
       .write.mode("overwrite").option("partitionOverwriteMode", "static").options(**BLOOM)
       .partitionBy(*PARTITION_COLS).parquet(staged_path(path)))


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a replacement that was interrupted; True if there was one.

    A staged table that is complete replaces its directories in the table
    (again, which changes nothing if they were replaced already); one that is
    not complete is dropped, as the table was not touched yet.
    """
    staged = staged_path(path)
    if not table_exists(spark, staged):
        return False
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(staged + "/_SUCCESS")
    complete = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)
    if complete:
        (read_partitioned(spark, staged).sortWithinPartitions(*PARTITION_COLS, *CLUSTER_COLS)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**BLOOM)
         .partitionBy(*PARTITION_COLS).parquet(path))
    discard(spark, staged)
    return complete


def upsert(batch: DataFrame, path: str, key_cols=("kks", "date", "time"),
           rank: Column | None = None, materialize_batch: bool = True,
           buckets: int | None = None) -> None:
    """Latest-wins upsert of ``batch`` (kks, date, time, value) into ``path``.

    Without ``rank`` the batch holds one row per key. With ``rank`` (see
    :func:`file_rank`) it may hold several, and the row of the greatest rank
    wins; choosing it and merging it with the stored row are one aggregate.
    ``buckets`` takes effect when the table is first written.

    The batch is evaluated twice when the table exists (the touched
    directories, then the merge), so it is written once to the shared
    checkpoint folder; ``materialize_batch=False`` is for batches that are
    read from such a table already.
    """
    spark = batch.sparkSession
    recover(spark, path)
    cols = [f.name for f in TABLE_SCHEMA.fields]
    typed = [F.col(f.name).cast(f.dataType) for f in TABLE_SCHEMA.fields if f.name != "kks_bucket"]
    r = (rank if rank is not None else F.lit(0)).cast(RANK)
    exists = table_exists(spark, path)
    n = table_buckets(spark, path) if exists else buckets or KKS_BUCKETS
    batch = with_bucket(batch.select(*typed, r.alias("__r")), n)
    if not exists:
        _write(_merge(batch, key_cols).select(*cols), path)
        set_buckets(spark, path, n)
        return
    tmp = None
    if materialize_batch:
        batch, tmp = materialize(batch, "upsert-batch")
    parts, parts_tmp = materialize(batch.select(*PARTITION_COLS).distinct(), "upsert-parts")
    # Days and bucket numbers: bounded by the calendar and the bucket count.
    days, numbers = parts.agg(F.collect_set("date"), F.collect_set("kks_bucket")).first()
    if numbers:
        old = (read_partitioned(spark, path)
               .where(F.col("date").isin(days) & F.col("kks_bucket").isin(numbers))
               .join(parts, list(PARTITION_COLS), "left_semi"))
        old = old.select(*cols, F.lit(-1).cast(RANK).alias("__r"))
        _stage(_merge(old.unionByName(batch.select(*cols, "__r")), key_cols).select(*cols), path)
        recover(spark, path)
    for t in (tmp, parts_tmp):
        if t:
            discard(spark, t)


def _merge(rows: DataFrame, key_cols) -> DataFrame:
    """One row per key: the one of the greatest ``__r`` (its value may be null)."""
    return rows.groupBy(*key_cols).agg(F.max_by("value", "__r").alias("value"),
                                       F.max("kks_bucket").alias("kks_bucket"))


def write_manifest(loaded_paths: DataFrame, root: str, day: _dt.date | None = None) -> str:
    """Manifest of loaded files for one day: ``index, path`` with a header row.

    Written to ``<root>/load_date=<day>``; a second run on the same day
    replaces it. Null paths are dropped.
    """
    day = day or _dt.date.today()
    out = f"{root.rstrip('/')}/load_date={day.isoformat()}"
    (loaded_paths.where("path IS NOT NULL")
     .select(F.monotonically_increasing_id().cast("string").alias("index"), "path")
     .write.mode("overwrite").option("header", True).csv(out))
    return out


def read_manifests(spark: SparkSession, paths) -> DataFrame:
    """Union of loaded-file manifests: header skipped, second column = ``path``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.schema("index string, path string").option("header", True)
            .csv(paths).select("path"))
