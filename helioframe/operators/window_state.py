"""Window means kept up to date from mergeable states.

A state row holds, for a sensor and a window, the sum and count of its numbers
and the counts of its nulls and NaNs; the mean follows from it. A batch that
brings new keys only adds its own states to the stored ones. Where it replaces
a value (the raw table keeps the latest value of a key), the window is counted
again from the raw rows of that window; rows sent again with the same value
change nothing. So a late batch touches its own windows, not whole days.

A load stages the new states, upserts the raw table, and then replaces the
touched days of the state table. If it dies in between, the staged windows are
counted again from the raw table by the next load (:func:`recover_state`), so
no row counts twice or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helioframe.functions.timefns import to_utc
from helioframe.session import discard, materialize
from helioframe.sources.sinks import read_partitioned, table_exists, upsert

SUMS = ("total", "n", "n_nan", "n_null")
KEYS = ("kks", "time")
STATE_SCHEMA = T.StructType([T.StructField("kks", T.StringType()), T.StructField("time", T.TimestampNTZType()),
                             T.StructField("total", T.DoubleType()), *[T.StructField(c, T.LongType()) for c in SUMS[1:]],
                             T.StructField("date", T.DateType())])


def _start(duration: str, tz: str | None) -> Column:
    t = to_utc("time", tz) if tz else F.col("time")
    return F.window(t, duration).start.cast("timestamp_ntz")


def window_states(rows: DataFrame, duration: str = "1 minute", tz: str | None = None) -> DataFrame:
    """``kks, time`` (window start, UTC if ``tz`` is given) and the sums of its rows."""
    number = F.col("value").isNotNull() & ~F.isnan("value")
    return (rows.where("time is not null").withColumn("__start", _start(duration, tz)).groupBy("kks", F.col("__start").alias("time"))
            .agg(F.coalesce(F.sum(F.when(number, F.col("value"))), F.lit(0.0)).alias("total"),
                 F.count_if(number).alias("n"), F.count_if(F.isnan("value")).alias("n_nan"),
                 F.count_if(F.col("value").isNull()).alias("n_null")))


def merged(states: DataFrame) -> DataFrame:
    """States of the same window added up."""
    return states.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


def means(states: DataFrame) -> DataFrame:
    """``kks, time, value``: null if a window holds no value, NaN if it holds one."""
    nan = F.lit(float("nan"))
    return states.select(*KEYS, F.when(F.col("n_nan") > 0, nan).when(F.col("n") > 0, F.col("total") / F.col("n")).alias("value"))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return read_partitioned(spark, path, STATE_SCHEMA).select(*KEYS, *SUMS)


def _staged(path: str) -> str:
    return path.rstrip("/") + "__state_staged"


def _with_day(states: DataFrame) -> DataFrame:
    return states.select(*KEYS, *SUMS, F.to_date("time").alias("date"))


def _write(states: DataFrame, path: str) -> None:
    (_with_day(states).repartition("date").sortWithinPartitions(*KEYS).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path))


def _of_windows(raw: DataFrame, windows: DataFrame, duration: str, tz: str | None) -> DataFrame:
    """Raw rows that lie in the given windows (``kks, start``)."""
    rows = raw.where("time is not null").withColumn("start", _start(duration, tz))
    return rows.join(windows, ["kks", "start"], "left_semi").select("kks", "date", "time", "value")


def _replace_days(spark: SparkSession, new: DataFrame, path: str) -> None:
    """Put new states of windows in the place of the stored ones of their days."""
    days = [r[0] for r in new.select(F.to_date("time")).distinct().collect()]     # bounded by the calendar
    if not days:
        return
    if table_exists(spark, path):
        old = read_partitioned(spark, path, STATE_SCHEMA).where(F.col("date").isin(days)).select(*KEYS, *SUMS)
        new, tmp = materialize(old.join(new.select(*KEYS), list(KEYS), "left_anti").unionByName(new), "states")
        _write(new, path)
        discard(spark, tmp)
    else:
        _write(new, path)


def recover_state(spark: SparkSession, raw_path: str, path: str, duration: str, tz: str | None) -> bool:
    """Finish a load that died: count its windows again from the raw table. True if there was one."""
    staged = _staged(path)
    if not table_exists(spark, staged):
        return False
    windows = read_partitioned(spark, staged, STATE_SCHEMA).select("kks", F.col("time").alias("start"))
    if table_exists(spark, raw_path):
        _replace_days(spark, window_states(_of_windows(read_partitioned(spark, raw_path), windows, duration, tz), duration, tz), path)
    discard(spark, staged)
    return True


def load(batch: DataFrame, raw_path: str, path: str, duration: str = "1 minute", tz: str | None = None) -> None:
    """Upsert ``batch`` (kks, date, time, value; one row a key) and bring the states of its windows up to date."""
    spark = batch.sparkSession
    recover_state(spark, raw_path, path, duration, tz)
    rows, rows_tmp = materialize(batch.select("kks", "date", "time", "value"), "state-batch")
    key = ["kks", "date", "time"]
    if table_exists(spark, raw_path):
        days = [r[0] for r in rows.select("date").distinct().collect()]            # bounded by the calendar
        raw = read_partitioned(spark, raw_path).where(F.col("date").isin(days))
        known = raw.select(*key, F.col("value").alias("old"), F.lit(True).alias("known"))
        seen = rows.join(known, key, "left").withColumn("start", _start(duration, tz))
        fresh = seen.where("known is null")
        replaced = seen.where(F.col("known") & ~F.col("value").eqNullSafe(F.col("old"))).select("kks", "start").distinct()
        adds = window_states(fresh.join(replaced, ["kks", "start"], "left_anti").select("kks", "date", "time", "value"), duration, tz)
        # Windows with a replaced value: their rows as they will be. A window may reach into a neighbouring day of plant time.
        near = read_partitioned(spark, raw_path).where(F.col("date").between(
            F.date_sub(F.lit(min(days)), 1), F.date_add(F.lit(max(days)), 1))) if days else raw
        kept = _of_windows(near, replaced, duration, tz).join(rows.select(*key), key, "left_anti")
        again = window_states(kept.unionByName(_of_windows(rows, replaced, duration, tz)), duration, tz)
        if table_exists(spark, path):
            # Windows start within a day of their rows, whatever the zone.
            stored = read_partitioned(spark, path, STATE_SCHEMA)
            stored = stored.where(F.col("date").between(F.date_sub(F.lit(min(days)), 1), F.date_add(F.lit(max(days)), 1))) if days else stored.limit(0)
            adds = merged(adds.unionByName(stored.select(*KEYS, *SUMS).join(adds.select(*KEYS), list(KEYS), "left_semi")))
        new = adds.unionByName(again)
    else:
        new = window_states(rows, duration, tz)
    staged = _staged(path)
    _write(new, staged)
    upsert(rows, raw_path, materialize_batch=False)
    if table_exists(spark, staged):
        _replace_days(spark, read_states(spark, staged), path)
        discard(spark, staged)
    discard(spark, rows_tmp)
