"""Bootstrap interval of a mean per x, as a line plot draws it where x repeats.

Every row has a Poisson(1) weight in each replicate, a hash of the seed, the
replicate and the row's id, so the draw depends neither on the partitioning nor
on a retry. Tasks add up weights and weighted values of all replicates by
group; one grouped step adds these sums up and takes the quantiles of the
replicates' means. A group's rows are never brought together: what is moved is
one pair of sums a batch, so a group may hold any share of the rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.draws import mixed, uniform

#: Sums held by a task before it gives them on (groups times replicates).
HELD = 4_000_000
# Probabilities of at most k for a Poisson number of mean 1.
_UPTO = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


def weights(ids: np.ndarray, replicates: int, seed: int) -> np.ndarray:
    """Poisson(1) weights, a row for each id (64-bit hashes), a column for each replicate."""
    u = uniform(mixed(seed, np.arange(replicates)[None, :], ids[:, None]))
    return np.searchsorted(_UPTO, u, side="right").astype(np.float64)


def series_band(long: DataFrame, ids: list[str], time: str = "time", level: float = 95.0, replicates: int = 1000,
                seed: int = 0) -> DataFrame:
    """``time, series, n, value, low, high`` from rows ``time, series, value`` that ``ids`` tell apart.

    ``value`` is the mean of the values that are not null, ``low`` and ``high``
    the bootstrap interval of ``level`` percent. Of a single value all three
    are that value; without one they are null; with a NaN they are NaN.
    """
    series = long.schema["series"].dataType.simpleString()
    rows = long.select(F.col(time).alias("time"), "series", F.col("value").cast("double").alias("value"),
                       F.xxhash64(*ids).alias("id"))
    mean = rows.groupBy("time", "series").agg(F.count("value").alias("n"), F.avg("value").alias("value"))
    several = rows.where("value is not null").join(mean.where("n > 1").select("time", "series"), ["time", "series"], "left_semi")
    kind = several.schema["time"].dataType.simpleString()

    def sums(batches):
        held: dict = {}

        def give():
            keys = list(held)
            out = [held[k] for k in keys]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], types[0]), pa.array([k[1] for k in keys], types[1]),
                 pa.array([w for w, _ in out], pa.list_(pa.float64())), pa.array([s for _, s in out], pa.list_(pa.float64()))],
                names=["time", "series", "w", "s"])

        for batch in batches:
            types = [batch.schema.field(c).type for c in ("time", "series")]
            groups: dict = {}
            for k, key in enumerate(zip(batch.column("time").to_pylist(), batch.column("series").to_pylist(), strict=True)):
                groups.setdefault(key, []).append(k)
            value, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("value", "id"))
            for key, at in groups.items():
                w = weights(own[at].view(np.uint64), replicates, seed)
                old = held.get(key, (0.0, 0.0))
                held[key] = (old[0] + w.sum(axis=0), old[1] + value[at] @ w)
                if len(held) * replicates > HELD:
                    yield give()
        if held:
            yield give()

    def interval(t: pa.Table) -> pa.Table:
        w, s = (np.sum(t.column(c).to_pylist(), axis=0) for c in ("w", "s"))
        drawn = s[w > 0] / w[w > 0]
        low, high = np.percentile(drawn, [(100 - level) / 2, (100 + level) / 2]) if len(drawn) else (None, None)
        return pa.table({"time": t.column("time").slice(0, 1), "series": t.column("series").slice(0, 1),
                         "low": pa.array([low], pa.float64()), "high": pa.array([high], pa.float64())})

    parts = several.mapInArrow(sums, f"time {kind}, series {series}, w array<double>, s array<double>")
    band = parts.groupBy("time", "series").applyInArrow(interval, f"time {kind}, series {series}, low double, high double")
    out = mean.join(band, ["time", "series"], "left")
    return out.select(F.col("time").alias(time), "series", "n", "value", F.coalesce("low", "value").alias("low"),
                      F.coalesce("high", "value").alias("high"))
