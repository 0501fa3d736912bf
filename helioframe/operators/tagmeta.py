"""Tag-sheet operators: column drops, null profiles, shape, tag normalisation,
reconciliation against the tag table, point lookups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.functions.text import normalise_tag


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns; a name that is not a column is an error (Spark would ignore it)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*names)


def rows_with_any_null(df: DataFrame) -> DataFrame:
    """Rows in which at least one column is null."""
    cond = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in df.columns])
    return df.where(cond)


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one row wide (one partial/final aggregate)."""
    return df.select([F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def null_counts_long(df: DataFrame) -> DataFrame:
    """Nulls per column as ``column, nulls`` rows."""
    wide = null_counts(df)
    return wide.unpivot([], wide.columns, "column", "nulls")


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns: ``n_rows, n_cols``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"))


def count_present(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` holds a value: ``n_rows, n_present``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count(F.col(f"`{col}`")).alias("n_present"))


def normalised_tags(sheet: DataFrame, complete: str = "KKS COMPLETE",
                    plain: str = "KKS", out: str = "tag") -> DataFrame:
    """The sheet with its normalised tag column added (column names are
    case-insensitive, so ``out`` must differ from the sheet's ``KKS``)."""
    return sheet.withColumn(out, normalise_tag(F.col(f"`{complete}`"), F.col(f"`{plain}`")))


def tag_overlap(sheet_tags: DataFrame, table_tags: DataFrame, col: str = "kks") -> DataFrame:
    """Reconciliation counts: ``n_table, n_sheet`` (with repeats) and ``n_both``
    (distinct tags found on both sides).

    Both sides are tagged and grouped once by tag (partial counts before the
    shuffle, so a tag repeated on many rows costs one row per task), then a
    global aggregate sums the per-tag counts.
    """
    a = sheet_tags.select(F.col(col).alias("t"), F.lit(1).alias("side"))
    b = table_tags.select(F.col(col).alias("t"), F.lit(2).alias("side"))
    per_tag = a.unionByName(b).groupBy("t").agg(
        F.count_if(F.col("side") == 1).alias("ns"), F.count_if(F.col("side") == 2).alias("nt"))
    return per_tag.agg(
        F.coalesce(F.sum("nt"), F.lit(0)).alias("n_table"),
        F.coalesce(F.sum("ns"), F.lit(0)).alias("n_sheet"),
        F.count_if(F.col("t").isNotNull() & (F.col("ns") > 0) & (F.col("nt") > 0))
         .alias("n_both"))


def tag_intersection(sheet_tags: DataFrame, table_tags: DataFrame, col: str = "kks") -> DataFrame:
    """Distinct tags present on both sides."""
    return sheet_tags.select(col).intersect(table_tags.select(col))


def tags_unmatched(sheet_tags: DataFrame, table_tags: DataFrame, col: str = "kks") -> DataFrame:
    """Distinct tags on one side only: ``kks, side`` (full outer join of distincts)."""
    a = sheet_tags.select(F.col(col).alias("a")).distinct()
    b = table_tags.select(F.col(col).alias("b")).distinct()
    j = a.join(b, a["a"] == b["b"], "full")
    return j.where(F.col("a").isNull() | F.col("b").isNull()).select(
        F.coalesce("a", "b").alias(col),
        F.when(F.col("a").isNull(), F.lit("table")).otherwise(F.lit("sheet")).alias("side"))


def lookup(df: DataFrame, **equals) -> DataFrame:
    """Point lookup: rows whose columns equal the given values (pushed to the scan)."""
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in equals.items()])
    return df.where(cond)
