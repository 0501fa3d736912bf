"""Tumbling-window means per sensor (the aggregation stage).

One plan covers every sensor: ``groupBy(kks, window(time, d))`` is a hash
aggregate with a map-side partial step, and its shuffle key includes the
window, so a sensor holding a third of all rows still spreads over many
tasks. No global sort is placed before a sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from helioframe.functions.timefns import PLANT_TZ, from_utc, to_utc


def window_mean(df: DataFrame, duration: str = "1 minute", key: str = "kks",
                time: str = "time", value: str | None = "value",
                start_time: str | None = None) -> DataFrame:
    """Mean per (key, tumbling window) -> ``key, window, value``.

    Windows are ``[start, end)``; rows with a null time are dropped; null
    values are skipped and NaN propagates; an all-null window gives null.

    ``value=None`` averages *every* numeric non-key column, naming each
    ``avg(<col>)`` like an argument-less ``avg()`` does.
    """
    w = F.window(time, duration, startTime=start_time) if start_time else F.window(time, duration)
    # Group on the window start only (one long in the shuffle instead of a
    # two-field struct); the struct is rebuilt after the aggregate.
    grouped = df.groupBy(key, w.start.alias("__start"))
    if value is not None:
        aggs = [F.avg(value).alias(value)]
    else:
        cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, NumericType) and f.name not in (key, time)]
        aggs = [F.avg(c).alias(f"avg({c})") for c in cols]
    out = grouped.agg(*aggs)
    window = F.struct(F.col("__start").alias("start"),
                      (F.col("__start") + F.expr(f"interval {duration}")).alias("end"))
    return out.select(key, window.alias("window"), *[a for a in out.columns
                                                    if a not in (key, "__start")])


def window_start(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace the window struct by its start as ``time``."""
    rest = [c for c in df.columns if c != window]
    return df.select(F.col(f"{window}.start").alias("time"), *rest)


def sort_by_window(df: DataFrame, key: str = "kks", window: str = "window") -> DataFrame:
    """Display order: by window start, then sensor (a range-partitioned sort)."""
    return df.orderBy(F.col(f"{window}.start"), F.col(key))


def local_window_mean(df: DataFrame, duration: str = "1 minute", tz: str = PLANT_TZ,
                      key: str = "kks", time: str = "time",
                      value: str = "value") -> DataFrame:
    """The aggregation stage on one table: local -> UTC, window mean, UTC -> local.

    Input times are plant wall times; windows are aligned in UTC (for windows
    longer than the zone offset granularity they do not follow plant days).
    Output: ``kks, time`` (window start, plant wall time), ``value``.
    """
    utc = df.select(F.col(key).alias(key), to_utc(time, tz).alias(time), F.col(value))
    agg = window_mean(utc, duration, key=key, time=time, value=value)
    return agg.select(F.col(key), from_utc(F.col("window.start"), tz).alias(time),
                      F.col(value))
