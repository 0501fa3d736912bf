"""String functions on paths and sensor tags (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_path(c) -> Column:
    """Percent-decode a file URI as Spark reports it (``%23`` -> ``#``).

    A literal ``+`` is protected first so that url_decode keeps it.
    """
    return F.url_decode(F.replace(_col(c), F.lit("+"), F.lit("%2B")))


def basename(c) -> Column:
    """Last path element; both ``/`` and ``\\`` separate."""
    return F.regexp_extract(_col(c), r"[^/\\]*$", 0)


def tag_from_path(c, kks: str | None = None) -> Column:
    """Sensor tag of a measurement file: its name without the last 4 characters.

    The name is expected to end in ``.csv``; as specified, the last four
    characters are cut whatever they are. An explicit ``kks`` wins.
    """
    name = basename(c)
    stem = name.substr(F.lit(1), F.greatest(F.length(name) - 4, F.lit(0)))
    return F.coalesce(F.lit(kks), stem) if kks else stem


def normalise_tag(complete, fallback) -> Column:
    """Tag from a sheet row: text after the first ``::`` with ``/`` -> ``_``.

    Rows whose complete tag is missing keep the plain tag. A complete tag
    without ``::`` gives null instead of failing.
    """
    complete = _col(complete)
    part = F.get(F.split(complete, "::"), 1)
    return F.when(complete.isNotNull(), F.replace(part, F.lit("/"), F.lit("_"))) \
        .otherwise(_col(fallback))
