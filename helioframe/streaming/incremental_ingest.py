"""Incremental ingest of measurement files with Structured Streaming.

"Load the files that are not loaded yet" (wanted list minus loaded
manifests) is what a streaming file source does by itself: its checkpoint
log records every file it has handed to a micro-batch, so each file is
processed once, and a restarted query continues where it stopped.

Each micro-batch (``foreachBatch``) applies the batch ingest rules to the
files it received: files below the size limit are skipped, a file with any
unparsable row is rejected whole, and rows are merged with the rank of the
batch ingest (first non-null within a file, last file between files). The
source hands files out by modification time, so ``maxFilesPerTrigger`` does
not change the table, only how much one micro-batch holds. Manifest rows are
written to the micro-batch's own partition, so a replayed batch replaces
them, and the upsert of a replayed batch leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from helioframe.functions.text import decode_path
from helioframe.functions.timefns import PLANT_TIME_FORMATS
from helioframe.operators.ingest import STATUS_LOADED, file_outcomes
from helioframe.plans.ingest_job import load_rows, numbered
from helioframe.session import discard, materialize
from helioframe.sources.measurement_csv import (MIN_FILE_BYTES, TEXT_SCHEMA,
                                                small_file_rule, tag_column,
                                                typed)


def measurement_stream(spark: SparkSession, source_dir: str, max_files: int = 1000) -> DataFrame:
    """Streaming scan of the measurement files with file path, size, time and position."""
    raw = (spark.readStream.schema(TEXT_SCHEMA)
           .option("sep", ";").option("header", False)
           .option("maxFilesPerTrigger", max_files)
           .option("recursiveFileLookup", "true")
           .csv(source_dir))
    return raw.select(
        decode_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"),
        "ts_text", "value_text")


def _process_batch(raw_table: str, manifest_dir: str | None, tag_from: str, kks: str | None,
                   formats, min_bytes: int):
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = typed(batch.withColumn("rid", F.monotonically_increasing_id()), formats)
        rows, rows_path = materialize(rows.drop("ts_text", "value_text"), "stream-rows")
        files = rows.groupBy("path").agg(F.max("length").alias("length"), F.max("modified").alias("modified"))
        files, files_path = numbered(small_file_rule(files, min_bytes)
                                     .withColumn("kks", tag_column("path", tag_from, kks)))
        by_file = rows.join(files.select("path", "file_no"), "path")
        status, status_path = materialize(file_outcomes(files, by_file.select("file_no", "bad"), "file_no"),
                                          "stream-outcomes")
        if status.where(F.col("status") == STATUS_LOADED).limit(1).count():
            load_rows(by_file.select("file_no", "block", "rid", "time", "value"), status, raw_table)
        if manifest_dir:
            (status.select("path", "length", "rows", "bad_rows", "status", F.lit(epoch).cast("long").alias("batch"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch").parquet(manifest_dir))
        for path in (rows_path, files_path, status_path):
            discard(spark, path)
    return run


def start_ingest(spark: SparkSession, source_dir: str, raw_table: str, checkpoint: str,
                 manifest_dir: str | None = None, *, tag_from: str = "name",
                 kks: str | None = None, formats=PLANT_TIME_FORMATS,
                 max_files: int = 1000, min_bytes: int = MIN_FILE_BYTES,
                 available_now: bool = True, processing_time: str | None = None
                 ) -> StreamingQuery:
    """Start the incremental ingest; ``available_now`` processes what is there and stops.

    ``checkpoint`` must be a shared, durable folder (it holds the source log
    of processed files and the batch commits).
    """
    stream = measurement_stream(spark, source_dir, max_files)
    w = (stream.writeStream
         .foreachBatch(_process_batch(raw_table, manifest_dir, tag_from, kks, formats,
                                      min_bytes))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
