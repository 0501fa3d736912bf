"""Positional operators: exact row index, chronological split, contiguous
k-fold assignment, head/tail/row-at, inclusive time slices.

The exact 0-based position of each row in a total order is computed
without funnelling rows into one task: the data are range-partitioned and
sorted (``orderBy``), every row records its partition id and its
increasing id inside the partition, and the rows are written once as a
Parquet table in the shared checkpoint folder, so the layout is frozen in
the data itself (a retry or a re-read cannot change it). A per-partition count
table (one row per partition, so its size is bounded by the partition
count and it is safe to broadcast) gives each partition its offset.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helioframe.functions.timefns import ntz_lit
from helioframe.session import ensure_checkpoint_dir, materialize


@dataclass
class Indexed:
    df: DataFrame     # input columns + idx (0-based position)
    n: int            # number of rows
    path: str         # scratch table the rows lie in, for session.discard


def _order(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_row_index(df: DataFrame, order, idx: str = "idx") -> Indexed:
    """Add the exact 0-based position of each row in ``order``.

    ``order`` should be a total order (add tie-breaking columns); rows equal
    on every order column get distinct, arbitrary but fixed positions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    laid, path = materialize(df.orderBy(*_order(order))
                          .select("*", F.spark_partition_id().alias("__pid"),
                                  F.monotonically_increasing_id().alias("__mid")),
                          "row-index")
    per = laid.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"),
                                    F.min("__mid").alias("__first"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("__pid", "__first",
                         F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"),
                         "__cnt")
    n = offsets.agg(F.sum("__cnt")).first()[0] or 0
    out = (laid.join(F.broadcast(offsets.drop("__cnt")), "__pid")
               .withColumn(idx, F.col("__off") + F.col("__mid") - F.col("__first"))
               .drop("__pid", "__mid", "__first", "__off"))
    return Indexed(out, int(n), path)


def split_point(n: int, train_fraction: float = 0.8) -> int:
    """Number of training rows: ``int(n * fraction)`` (floor, as specified)."""
    return int(n * train_fraction)


def chrono_split(df: DataFrame, order, train_fraction: float = 0.8,
                 idx: str = "idx", flag: str = "split") -> tuple[DataFrame, int, int]:
    """Label rows ``train``/``validation`` by position; no shuffling of rows.

    Returns (frame with ``idx`` and ``split``, number of rows, training rows).
    """
    ind = with_row_index(df, order, idx)
    k = split_point(ind.n, train_fraction)
    out = ind.df.withColumn(flag, F.when(F.col(idx) < k, F.lit("train"))
                            .otherwise(F.lit("validation")))
    return out, ind.n, k


def fold_of(idx: Column | str, n: int, k: int = 5) -> Column:
    """Contiguous fold of a 0-based position among ``n`` rows (larger folds first).

    With ``q, r = divmod(n, k)`` the first ``r`` folds hold ``q + 1`` rows.
    """
    i = F.col(idx) if isinstance(idx, str) else idx
    q, r = divmod(n, k)
    big = r * (q + 1)
    if q == 0:
        return i.cast("int")
    return F.when(i < big, F.floor(i / (q + 1))) \
            .otherwise(F.lit(r) + F.floor((i - big) / q)).cast("int")


def kfold(df: DataFrame, order, k: int = 5, fold: str = "fold",
          idx: str = "idx") -> DataFrame:
    """Contiguous k-fold labels in ``order`` (unshuffled cross-validation)."""
    ind = with_row_index(df, order, idx)
    return ind.df.withColumn(fold, fold_of(idx, ind.n, k))


def head(df: DataFrame, order, n: int = 5) -> DataFrame:
    """First ``n`` rows in ``order`` (distributed top-k)."""
    return df.orderBy(*_order(order)).limit(n)


def tail(df: DataFrame, order, n: int = 5) -> DataFrame:
    """Last ``n`` rows in ``order``, returned in ascending order."""
    desc = [c.desc() for c in _order(order)]
    return df.orderBy(*desc).limit(n).orderBy(*_order(order))


def row_at(df: DataFrame, order, pos: int) -> DataFrame:
    """The row at 0-based position ``pos`` in ``order`` (empty if past the end).

    A filter on the exact row index, whatever the position, so no task keeps
    ``pos`` rows and rows equal in ``order`` are told apart in one way.
    """
    return with_row_index(df, order, "__idx").df.where(F.col("__idx") == pos).drop("__idx")


def time_slice(df: DataFrame, time: str, start, days: float = 1.0) -> DataFrame:
    """Rows with ``start <= time <= start + days`` (both ends included)."""
    t0 = ntz_lit(start)
    secs = int(round(days * 86400))
    t1 = t0 + F.expr(f"interval {secs} seconds")
    return df.where(F.col(time).between(t0, t1))
