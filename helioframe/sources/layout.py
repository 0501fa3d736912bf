"""Physical layout of the plant tables (raw measurements, window means).

Directories are ``date=<day>/kks_bucket=<b>`` with ``b = pmod(xxhash64(kks),
KKS_BUCKETS)``, and rows inside each file are sorted by ``(kks, time)``.

* A read for some tags and days prunes whole directories on ``date`` and
  ``kks_bucket`` (``PartitionFilters``) and then Parquet row groups on
  ``kks`` (``PushedFilters``; files are clustered by tag).
* The directory count is ``days x buckets`` whatever the number of tags,
  so many sensors do not turn into millions of tiny files, and a sensor
  with a third of all rows is split into many files by ``REBALANCE``.
* An upsert rewrites only the (day, bucket) directories its batch touches.

The bucket count belongs to the table: it is given when the table is first
written (64 by default; 1 for small tables such as window means) and kept in
the name of an empty marker file beside the data, where every writer and
keyed reader finds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, StringType,
                               StructField, StructType, TimestampNTZType)

# Tag hash buckets per day of a table that was not given another number.
KKS_BUCKETS = 64
_MARKER = "_kks_buckets="

PARTITION_COLS = ("date", "kks_bucket")
CLUSTER_COLS = ("kks", "time")

TABLE_SCHEMA = StructType([
    StructField("kks", StringType()),
    StructField("date", DateType()),
    StructField("time", TimestampNTZType()),
    StructField("value", DoubleType()),
    StructField("kks_bucket", IntegerType()),
])


def kks_bucket(c="kks", buckets: int = KKS_BUCKETS) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def with_bucket(df: DataFrame, buckets: int = KKS_BUCKETS) -> DataFrame:
    return df.withColumn("kks_bucket", kks_bucket("kks", buckets))


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def set_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """Record a table's bucket count in the name of a marker file."""
    fs, p = _folder(spark, path)
    fs.create(p.suffix(f"/{_MARKER}{buckets}"), True).close()


def table_buckets(spark: SparkSession, path: str) -> int:
    """A table's bucket count (the default for tables without a marker)."""
    fs, p = _folder(spark, path)
    if fs.exists(p):
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith(_MARKER):
                return int(name[len(_MARKER):])
    return KKS_BUCKETS
