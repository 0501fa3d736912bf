"""Window-mean table -> wide feature table (the glue between aggregation and
training).

One row per window start, one column per sensor (mean value), built with a
pivot over a given tag list, so no extra pass is needed to find the tags.
Tag names such as ``11CXA01GZ001XK05_A.PV_Out#Value`` are not usable as
ML column names (``.`` means struct access), so columns get safe names and
the mapping is returned. Rows missing any selected sensor are dropped,
because the models need every feature.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.operators.report import to_wide


def safe_name(tag: str) -> str:
    s = re.sub(r"[^0-9A-Za-z_]", "_", tag)
    return s if s and not s[0].isdigit() else f"t_{s}"


def wide_features(agg: DataFrame, tags: list[str], time: str = "time",
                  drop_incomplete: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """``agg`` (kks, time, value) -> (``time`` + one column per tag, tag -> column)."""
    names = {}
    for t in tags:
        n = safe_name(t)
        while n in names.values():
            n += "_"
        names[t] = n
    wide = to_wide(agg.select("kks", time, "value"), list(tags), time=time)
    out = wide.select(F.col(time), *[F.col(f"`{t}`").alias(names[t]) for t in tags])
    if drop_incomplete:
        out = out.dropna(subset=list(names.values()))
    return out, names
