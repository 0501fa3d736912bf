"""Measurement CSV files: discovery, the small-file rule, and the typed scan.

A measurement file holds one sensor: no header, ``;`` separated, a
day-first timestamp and a number with a decimal comma. The sensor tag is
the file name without its last four characters (``<tag>.csv``), or the
``kks=<tag>`` folder a Spark writer puts it in.

Discovery lists the folder with the ``binaryFile`` source without reading
file contents, and the folder itself is scanned and joined with the listing.
Listed files are looked up one by one and scanned by their paths, in which
glob characters stand for themselves.
"""

from __future__ import annotations

import datetime as _dt
import re
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.functions.text import basename, decode_path, tag_from_path
from helioframe.functions.timefns import (PLANT_TIME_FORMATS, is_blank,
                                          is_missing, parse_day_first,
                                          parse_decimal_comma)
from helioframe.session import scratch_path

#: Names looked up in the file system at a time.
STAT_GROUP = 4_096
# Fixed value: files smaller than this many bytes are skipped unread.
MIN_FILE_BYTES = 100

TEXT_SCHEMA = "ts_text string, value_text string"


def literal(path: str) -> str:
    """A path in which glob characters stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def plain_uri(path):
    """A decoded path as all sources are made to report it: ``file:/x`` for any number of slashes."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def list_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """All files under ``root``: ``path`` (plain, not percent-encoded), ``length``, ``modified``.

    Empty files are listed too: they have no split and so no row in the
    ``binaryFile`` source, but are among its input files (the listing that
    Spark holds on the driver for any folder it reads).
    """
    source = (spark.read.format("binaryFile")
              .option("recursiveFileLookup", str(recursive).lower())
              .option("pathGlobFilter", "*").load(literal(root)))
    seen = source.select(plain_uri("path").alias("path"), "length", F.col("modificationTime").alias("modified"))
    every = spark.createDataFrame([(f,) for f in source.inputFiles()], "uri string")
    every = every.select(plain_uri(decode_path("uri")).alias("path"))
    return (every.join(seen, "path", "left")
            .select("path", F.coalesce("length", F.lit(0)).alias("length"), "modified"))


def read_file_list(spark: SparkSession, list_csv: str) -> DataFrame:
    """A list of file names: one column, no header -> ``file``."""
    return spark.read.schema("file string").option("header", False).csv(list_csv)


def list_inputs(spark: SparkSession, root: str, list_csv: str | None = None,
                names: list[str] | None = None, recursive: bool = False) -> DataFrame:
    """Input files: ``path, name, length, modified, missing``.

    Precedence as specified: a list file, else an explicit list of names,
    else every file of the folder (with its sub-folders if ``recursive``).
    Names are relative to the folder; one that is not there has a row with
    ``missing`` set and no length.
    """
    if list_csv:
        wanted = read_file_list(spark, list_csv)
    elif names:
        wanted = spark.createDataFrame([(n,) for n in names], "file string")
    else:
        return list_files(spark, root, recursive).select(
            "path", basename("path").alias("name"), "length", "modified", F.lit(False).alias("missing"))
    wanted = wanted.select(F.translate("file", "\\", "/").alias("below")).where("below <> ''").distinct()
    found = _stat(spark, wanted, root)
    return found.select("path", basename("below").alias("name"), "length", "modified", F.col("length").isNull().alias("missing"))


def _stat(spark: SparkSession, wanted: DataFrame, root: str) -> DataFrame:
    """``below, path, length, modified`` of names below a folder, null where there is no such file.

    Only the names are looked up, the folder is not listed. The driver asks
    the file system for ``STAT_GROUP`` names at a time and writes what it
    learns to a scratch table, so its memory does not grow with the list.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = fs.makeQualified(top).toString().rstrip("/")
    out = scratch_path(spark, "stat")
    schema = "below string, uri string, length long, modified timestamp"

    def asked(name: str) -> tuple:
        # Names stay below the folder; hidden files are none, as in a listing.
        if not any(part.startswith((".", "_")) for part in name.split("/")):
            p = jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")
            if fs.exists(p):
                st = fs.getFileStatus(p)
                if st.isFile():
                    at = _dt.datetime.fromtimestamp(st.getModificationTime() / 1000, _dt.timezone.utc)
                    return name, st.getPath().toString(), st.getLen(), at
        return name, f"{base}/{name}", None, None

    names = (r["below"] for r in wanted.toLocalIterator())
    spark.createDataFrame([], schema).write.parquet(out)
    while group := list(islice(names, STAT_GROUP)):
        with ThreadPoolExecutor(8) as pool:
            rows = list(pool.map(asked, group))
        spark.createDataFrame(rows, schema).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out).select("below", plain_uri("uri").alias("path"), "length", "modified")


def small_file_rule(files: DataFrame, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    """Flag files below ``min_bytes``: adds boolean ``small``."""
    return files.withColumn("small", F.col("length") < F.lit(min_bytes))


def scan_text(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> DataFrame:
    """Untyped scan of measurement files (or of a folder) with file position columns.

    Output: ``path`` (decoded), ``block`` (start byte of the split), ``rid``
    (increasing within a split), ``ts_text``, ``value_text``. ``(path,
    block, rid)`` orders the rows of a file as they are written.
    """
    paths = [paths] if isinstance(paths, str) else paths
    df = (spark.read.schema(TEXT_SCHEMA)
          .option("sep", ";").option("header", False)
          .option("mode", "PERMISSIVE").option("recursiveFileLookup", str(recursive).lower())
          .csv([literal(p) for p in paths]))
    return df.select(
        plain_uri(decode_path(F.col("_metadata.file_path"))).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("rid"),
        "ts_text", "value_text")


def no_text(spark: SparkSession) -> DataFrame:
    """The columns of :func:`scan_text` without rows."""
    return spark.createDataFrame([], "path string, block long, rid long, ts_text string, value_text string")


def typed(text: DataFrame, formats=PLANT_TIME_FORMATS) -> DataFrame:
    """Parse text columns: adds ``time`` (timestamp_ntz), ``value`` (double), ``bad``.

    ``bad`` marks non-empty text that does not parse; an empty time (row is
    later dropped) or a missing value (empty or a null token) is not bad.
    """
    t = parse_day_first("ts_text", formats)
    v = parse_decimal_comma("value_text")
    return (text
            .withColumn("time", t)
            .withColumn("value", v)
            .withColumn("bad", (~is_blank("ts_text") & F.col("time").isNull())
                        | (~is_missing("value_text") & F.col("value").isNull())))


def tag_column(path_col: str = "path", tag_from: str = "name",
               kks: str | None = None):
    """Tag of each row: ``name`` = file name minus 4 chars; ``folder`` = ``kks=<tag>``."""
    if tag_from == "folder":
        enc = F.regexp_extract(F.col(path_col), r"/kks=([^/]*)/[^/]*$", 1)
        tag = decode_path(enc)   # undo the writer's path escaping
        return F.coalesce(F.lit(kks), tag) if kks else tag
    return tag_from_path(path_col, kks)


def write_plant_csv(df: DataFrame, out: str, order: tuple[str, ...] = ("time",),
                    partitions: int | None = None) -> None:
    """Write ``kks, time, value`` as measurement files, one folder per tag.

    Rows are range-partitioned on the tag and the second (the files' precision,
    so equal times share a file) and sorted by (kks, *order).
    """
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    keys = ["kks"] + [f"__o{i}" for i in range(len(order))]
    (df.select(
        "kks",
        F.date_format("time", "dd/MM/yyyy HH:mm:ss").alias("ts_text"),
        F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")).alias("value_text"),
        F.col("time").alias("__time"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)])
     .withColumn("__second", F.date_trunc("second", F.col("__time")))
     .repartitionByRange(n, "kks", "__second")
     .sortWithinPartitions(*keys)
     .drop(*keys[1:], "__time", "__second")
     .write.mode("overwrite").partitionBy("kks")
     .option("sep", ";").option("header", False)
     .csv(out))
