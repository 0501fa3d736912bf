"""CSV files -> raw table: one Spark job for all files.

discover (list/names/folder) -> small-file rule -> typed scan -> per-file
outcome (whole-file rejection) -> tag from file -> day key -> latest-wins
upsert -> manifest of loaded files.

Within a file the first non-null value of a (kks, time) wins; between files
the last one does, by modification time and then path. Files are numbered in
that order, and both rules are one fixed-width rank of the upsert's merge, so
the result is the same for one run over all files, a run for each file, and
a stream with any number of files in a micro-batch.

Files given by name or by a list are read by their paths, the rest of the
folder is neither listed nor read. All is parsed once: the typed rows are written to the shared
checkpoint folder with their file's number, the outcomes are counted from
them, and the rows of the loaded files (a join with one row per file) go
into the upsert.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.functions.timefns import PLANT_TIME_FORMATS
from helioframe.operators.ingest import STATUS_LOADED, dedup_first, file_outcomes
from helioframe.operators.rows import with_row_index
from helioframe.session import discard, ensure_checkpoint_dir, materialize, scratch_path
from helioframe.sources.measurement_csv import (list_inputs, no_text, scan_text,
                                                small_file_rule, tag_column,
                                                typed)
from helioframe.sources.sinks import file_rank, upsert, write_manifest


#: Listed files scanned at a time; the driver holds no more of their paths.
SCAN_GROUP = 10_000


@dataclass
class IngestResult:
    outcomes: DataFrame      # file_no, path, kks, length, modified, rows, bad_rows, status


def numbered(files: DataFrame) -> tuple[DataFrame, str]:
    """Files with ``file_no``, their place by (modified, path), and where that table lies."""
    indexed = with_row_index(files, ["modified", "path"], "file_no")
    return indexed.df, indexed.path


def parse_files(spark: SparkSession, paths: list[str], tag_from: str = "name",
                kks: str | None = None, formats=PLANT_TIME_FORMATS) -> DataFrame:
    """Typed rows of the given files, the first non-null value per (file, kks, time):
    ``path, kks, date, time, value``."""
    rows = typed(scan_text(spark, paths), formats).where("time IS NOT NULL")
    rows = rows.select("path", tag_column("path", tag_from, kks).alias("kks"), "time", "value",
                       F.struct("block", "rid").alias("place"))
    return (dedup_first(rows, ["path", "kks", "time"], "value", "place")
            .select("path", "kks", F.to_date("time").alias("date"), "time", "value"))


def _rows_of(text: DataFrame, readable: DataFrame, formats) -> DataFrame:
    return typed(text.join(readable, "path"), formats).select("file_no", "block", "rid", "time", "value", "bad")


def _rows_of_listed(spark: SparkSession, readable: DataFrame, formats) -> tuple[DataFrame, str]:
    """Typed rows of just the listed files: scans of ``SCAN_GROUP`` paths at a time into one table."""
    path = scratch_path(spark, "ingest-rows")
    paths = (r["path"] for r in readable.orderBy("file_no").select("path").toLocalIterator())
    group = list(islice(paths, SCAN_GROUP))
    while True:
        rows = _rows_of(scan_text(spark, group), readable, formats) if group else typed(no_text(spark), formats) \
            .select(F.lit(0).cast("long").alias("file_no"), "block", "rid", "time", "value", "bad")
        rows.write.mode("append").parquet(path)
        group = list(islice(paths, SCAN_GROUP))
        if not group:
            return spark.read.schema(rows.schema).parquet(path), path


def load_rows(rows: DataFrame, outcomes: DataFrame, raw_table: str) -> None:
    """Upsert the typed rows of the loaded files. ``rows`` is a written table."""
    good = outcomes.where(F.col("status") == STATUS_LOADED).select("file_no", "kks")
    batch = rows.where("time IS NOT NULL").join(good, "file_no")
    batch = batch.select("kks", F.to_date("time").alias("date"), "time", "value", file_rank().alias("rank"))
    upsert(batch, raw_table, rank=F.col("rank"), materialize_batch=False)


def ingest(spark: SparkSession, root: str, raw_table: str, *,
           list_csv: str | None = None, names: list[str] | None = None,
           kks: str | None = None, tag_from: str = "name", recursive: bool | None = None,
           manifest_root: str | None = None, day: _dt.date | None = None,
           formats=PLANT_TIME_FORMATS) -> IngestResult:
    """Load files of a folder. ``recursive`` defaults to False, or True for tags from folders."""
    ensure_checkpoint_dir(spark)
    recursive = tag_from == "folder" if recursive is None else recursive
    files = small_file_rule(list_inputs(spark, root, list_csv, names, recursive))
    files, files_path = numbered(files.withColumn("kks", tag_column("path", tag_from, kks)))
    readable = files.where("NOT missing AND NOT small").select("path", "file_no")
    if list_csv or names:
        rows, rows_path = _rows_of_listed(spark, readable, formats)
    else:
        rows, rows_path = materialize(_rows_of(scan_text(spark, root, recursive), readable, formats), "ingest-rows")
    outcomes, _ = materialize(file_outcomes(files, rows.select("file_no", "bad"), "file_no"), "ingest-outcomes")
    if outcomes.where(F.col("status") == STATUS_LOADED).limit(1).count():
        load_rows(rows, outcomes, raw_table)
    for path in (files_path, rows_path):
        discard(spark, path)
    if manifest_root:
        write_manifest(outcomes.where(F.col("status") == STATUS_LOADED).select("path"),
                       manifest_root, day)
    return IngestResult(outcomes=outcomes)
