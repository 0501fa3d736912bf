"""Helpers shared by the operators: batches, scratch tables, ranks, components."""

from __future__ import annotations

import gc
import math
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helioframe.session import discard, materialize

#: Rows handed to a Python worker at once; texts of a batch live in its memory.
ROWS_PER_BATCH = 512
#: Bytes handed to a Python worker at once, whatever the number of rows.
BYTES_PER_BATCH = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of Python stages, so that long texts fit in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grouped(rows: Iterable, limit: int, weight) -> Iterator[list]:
    """Consecutive runs of ``rows`` whose weights sum to at most ``limit`` (one row at least)."""
    run, total = [], 0
    for row in rows:
        w = weight(row)
        if run and total + w > limit:
            yield run
            run, total = [], 0
        run.append(row)
        total += w
    if run:
        yield run


def chunks(items: Iterable, size: int) -> Iterator[list]:
    it = iter(items)
    while part := list(islice(it, size)):
        yield part


_HELD: list = []


def held(key: tuple, make):
    """``make()`` for this key, kept by the Python worker until it is asked for another key.

    Workers serve one stage after the other; a stage's vocabulary and
    remembered words are let go when another stage needs its own.
    """
    if not _HELD or _HELD[0] != key:
        _HELD.clear()
        gc.collect()
        _HELD[:] = [key, make()]
    return _HELD[1]


class Scratch:
    """Tables written to the shared checkpoint folder; :meth:`drop` removes those no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        # Disk is what bounds the pipeline; texts pack better than by Spark's default codec.
        out, path = materialize(df, name, "zstd")
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        if path := getattr(df, "_scratch_path", None):
            discard(self.spark, path)


def rank_within(df: DataFrame, key: str, ties: Sequence[str], rows: int,
                rows_per_cell: int = 20_000, least_cells: int = 16) -> DataFrame:
    """Add ``rank``: gapless from 0 within each value of ``key``, in a fixed but arbitrary order.

    A value of ``key`` may hold any share of the ``rows`` rows: it is split
    into cells by a hash of ``ties`` (columns that together identify a row),
    so that no window holds more than about ``rows_per_cell`` rows.
    """
    cells = max(least_cells, math.ceil(rows / rows_per_cell))
    salted = df.withColumn("_cell", F.pmod(F.xxhash64(*ties), F.lit(cells)))
    before = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    base = (salted.groupBy(key, "_cell").agg(F.count(F.lit(1)).alias("_n"))
            .select(key, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    within = Window.partitionBy(key, "_cell").orderBy(*ties)
    return (salted.withColumn("_row", F.row_number().over(within))
            .join(base, [key, "_cell"])
            .withColumn("rank", F.col("_base") + F.col("_row") - 1)
            .drop("_cell", "_base", "_row"))


def components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)``: the smallest node reachable, for every node with a link to a smaller one.

    Alternates large-star and small-star steps (each a grouped minimum and a
    join) until the edges stop changing; every round is written to the shared
    folder, so a lost executor costs one round at most. The rounds grow with
    the logarithm of the longest chain.
    """
    scratch = Scratch(spark)
    now = scratch.keep(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                       .where("u <> v").distinct(), "links")
    state = None
    while True:
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))))
        nxt = scratch.keep(small.distinct(), "links")
        scratch.drop(now)
        now = nxt
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(seen) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = tuple(seen)
