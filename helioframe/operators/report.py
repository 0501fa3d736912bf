"""Comparison frames: measured series and model predictions side by side.

``compare_long`` slices a time range and unpivots the chosen series into
``time, series, value`` rows (what a line chart plots); ``series_mean``
is the per-x mean a line plot draws when x repeats. ``day_panels`` stacks
two one-day slices (a training day and a validation day) with a panel
label. ``to_wide`` is the long -> wide glue from the aggregate table
(one column per sensor) to a feature table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.operators.rows import time_slice


def compare_long(df: DataFrame, time: str, series: list[str], start=None, days: float = 7.0,
                 ids: list[str] | None = None) -> DataFrame:
    """``ids..., time, series, value`` for the series over ``[start, start+days]``."""
    part = time_slice(df, time, start, days) if start is not None else df
    keep = [*(ids or []), time]
    return part.select(*keep, *series).unpivot(keep, series, "series", "value")


def series_mean(long: DataFrame, time: str = "time") -> DataFrame:
    """Mean value per (time, series)."""
    return long.groupBy(time, "series").agg(F.avg("value").alias("value"))


def day_panels(df: DataFrame, time: str, series: list[str], train_day, validation_day,
               ids: list[str] | None = None) -> DataFrame:
    """Two inclusive one-day slices, labelled ``panel`` = train / validation."""
    a = compare_long(df, time, series, train_day, 1.0, ids).withColumn("panel", F.lit("train"))
    b = compare_long(df, time, series, validation_day, 1.0, ids) \
        .withColumn("panel", F.lit("validation"))
    return a.unionByName(b)


def to_wide(long: DataFrame, tags: list[str], time: str = "time", key: str = "kks",
            value: str = "value") -> DataFrame:
    """One row per time, one column per tag (mean of that tag at that time).

    The tag list is given, so the pivot needs no extra pass to find it.
    """
    return long.groupBy(time).pivot(key, list(tags)).agg(F.avg(value))
