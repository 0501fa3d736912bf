"""Ingest operators: per-file outcome, first-non-null dedup, day keys,
file-list differences and load summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.functions.text import basename

STATUS_LOADED = "loaded"
STATUS_SMALL = "skipped_small"
STATUS_REJECTED = "rejected"
STATUS_MISSING = "missing"


def file_outcomes(files: DataFrame, parsed: DataFrame, key: str = "path") -> DataFrame:
    """The offered files with ``rows, bad_rows, status`` added.

    ``files`` has ``key, length, small`` (and ``missing``); ``parsed`` is the
    typed scan of the files that were read (``key, bad``). A file with any bad
    row is rejected whole; a small file is skipped unread; a wanted file that
    is not there is missing. The per-file counts are a partial/final
    aggregate, so a large file is counted by many tasks.
    """
    counts = parsed.groupBy(key).agg(F.count(F.lit(1)).alias("rows"),
                                     F.count_if(F.col("bad")).alias("bad_rows"))
    out = files.join(counts, key, "left")
    status = (F.when(F.col("small"), F.lit(STATUS_SMALL))
              .when(F.coalesce(F.col("bad_rows"), F.lit(0)) > 0, F.lit(STATUS_REJECTED))
              .otherwise(F.lit(STATUS_LOADED)))
    if "missing" in files.columns:
        status = F.when(F.col("missing"), F.lit(STATUS_MISSING)).otherwise(status)
    return out.select(*files.columns, F.coalesce("rows", F.lit(0)).alias("rows"),
                      F.coalesce("bad_rows", F.lit(0)).alias("bad_rows"), status.alias("status"))


def first_non_null(value: str, order: Column) -> Column:
    """Aggregate: the first non-null ``value`` in ``order``; null if all are null."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), order))


def dedup_first(df: DataFrame, keys: list[str], value: str, order: Column | str) -> DataFrame:
    """One row per key with the first non-null value in ``order``.

    A key whose values are all null is kept with a null value. Keys with a
    null part are dropped (a missing timestamp never names a row). The
    aggregate has a map-side partial step and shuffles on the full key.
    """
    o = F.col(order) if isinstance(order, str) else order
    clean = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return clean.groupBy(*keys).agg(first_non_null(value, o).alias(value))


def distinct_days(df: DataFrame, time: str = "time", by: list[str] | None = None) -> DataFrame:
    """Distinct calendar days (optionally per ``by`` columns): column ``date``."""
    cols = [F.col(c) for c in (by or [])] + [F.to_date(time).alias("date")]
    return df.select(*cols).distinct()


def rows_of_day(df: DataFrame, day, date_col: str = "date") -> DataFrame:
    """Rows of one calendar day (a partition filter on a plant table)."""
    return df.where(F.col(date_col) == F.to_date(F.lit(str(day))))


def files_to_load(wanted: DataFrame, loaded: DataFrame) -> DataFrame:
    """Distinct wanted file names minus the names already loaded: ``file``.

    ``wanted`` has a ``file`` column of names; ``loaded`` a ``path`` column of
    full paths (either separator), reduced to their names first.
    """
    w = wanted.select(F.col("file")).where("file IS NOT NULL").distinct()
    # Both sides are made distinct first (map-side partial aggregates), so a
    # name repeated on many rows never lands whole in one join task.
    done = loaded.select(basename("path").alias("file")).where("file IS NOT NULL").distinct()
    return w.join(done, "file", "left_anti")


def load_summary(outcomes: DataFrame) -> DataFrame:
    """Files offered and files per status: ``status, files, rows``."""
    per = outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("files"),
                                         F.sum("rows").alias("rows"))
    total = outcomes.agg(F.lit("offered").alias("status"), F.count(F.lit(1)).alias("files"),
                         F.sum("rows").alias("rows"))
    return per.unionByName(total)
