"""Table scans: the raw and aggregate tables, tag tables, feature tables.

The plant tables are Parquet folders laid out by day and tag bucket (see
:mod:`helioframe.sources.layout`).
The ``*_from_*`` helpers map the driver's test tables onto the plant schemas
(column renames only, no row selection).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampNTZType

def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of a Parquet table (tag table, feature table, raw table)."""
    return spark.read.parquet(path)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A spreadsheet exported to CSV with a header row; every column a string."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def medidas_from_events(events: DataFrame) -> DataFrame:
    """``events`` seen as the raw measurement table (kks, date, time, value)."""
    return events.select(
        F.col("event_type").alias("kks"),
        F.to_date("ts").alias("date"),
        F.col("ts").cast(TimestampNTZType()).alias("time"),
        F.col("value").cast(DoubleType()).alias("value"),
    )


def sheet_from_part(part: DataFrame) -> DataFrame:
    """``part`` seen as the tag sheet ("Direct values").

    ``KKS`` = part name; ``KKS COMPLETE`` = ``<type>::<brand>/<name>``, missing
    for the SMALL type so that the plain tag is used there; the remaining
    sheet columns are carried as text.
    """
    return part.select(
        F.col("p_name").alias("KKS"),
        F.when(F.col("p_type") != "SMALL",
               F.concat_ws("::", F.col("p_type"),
                           F.concat_ws("/", F.col("p_brand"), F.col("p_name"))))
         .alias("KKS COMPLETE"),
        F.col("p_type").alias("HIERACHY"),
        F.col("p_brand").alias("KKS ENDING"),
        F.col("p_size").cast("string").alias("PI&D"),
        F.col("p_retailprice").cast("string").alias("SHEET"),
        F.lit(None).cast("string").alias("LOCATION"),
    )


def tag_table_from_part(part: DataFrame) -> DataFrame:
    """``part`` seen as the tag catalogue table ``kks(kks, plant, ...)``."""
    return part.select(
        F.concat_ws("_", F.col("p_brand"), F.col("p_name")).alias("kks"),
        F.col("p_type").alias("plant"),
        F.col("p_partkey").alias("id"),
    )
