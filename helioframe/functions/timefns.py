"""Time functions: parsing plant timestamps, zone shifts, day keys, date lists.

All times in the library are naive wall-clock values (``timestamp_ntz``);
zone conversion is explicit and independent of the session time zone.
Conversion follows java.time rules, which for Europe/Madrid means:

* spring gap: wall 02:30 does not exist and is read as 03:30 (both give
  01:30 UTC), so a round trip moves it to 03:30;
* autumn overlap: an ambiguous wall time takes the earlier offset.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

# The plant zone and the CSV formats of the measurement files.
PLANT_TZ = "Europe/Madrid"
PLANT_TIME_FORMATS = (
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss.SSS",
    "dd/MM/yyyy HH:mm",
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_day_first(c, formats=PLANT_TIME_FORMATS) -> Column:
    """Day-first timestamp text -> ``timestamp_ntz`` (null if no format fits).

    Formats are tried in order until one fits, one parse each. The session
    zone is UTC (:mod:`helioframe.session`), which has no gaps, so the wall
    time is kept as written.
    """
    s = F.trim(_col(c))
    parsed = [F.try_to_timestamp(s, F.lit(fmt)) for fmt in formats]
    return F.coalesce(*parsed).cast(TimestampNTZType())


# Texts that stand for a missing number.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def is_missing(c) -> Column:
    """Whether the text stands for no value: blank or one of the null tokens."""
    c = _col(c)
    return c.isNull() | F.trim(c).isin(*NULL_TOKENS)


def parse_decimal_comma(c) -> Column:
    """Locale number with ``,`` as decimal mark -> double (null if missing or not a number)."""
    s = F.regexp_replace(F.trim(_col(c)), ",", ".")
    return F.when(~is_missing(c), s.try_cast("double"))


def is_blank(c) -> Column:
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def day_of(c) -> Column:
    """Calendar day of a timestamp (the ``date`` partition key)."""
    return F.to_date(_col(c))


def to_utc(c, tz: str = PLANT_TZ) -> Column:
    """Wall time in ``tz`` -> UTC wall time (``timestamp_ntz``)."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _as_ntz(c))


def from_utc(c, tz: str = PLANT_TZ) -> Column:
    """UTC wall time -> wall time in ``tz`` (``timestamp_ntz``)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _as_ntz(c))


def _as_ntz(c) -> Column:
    # Under the UTC session a TIMESTAMP casts to its UTC wall clock.
    return _col(c).cast(TimestampNTZType())


def parse_instant(s: str, fmt: str = "%Y-%m-%d %H:%M") -> _dt.datetime:
    """Literal instant such as ``'2017-08-08 12:00'`` (driver-side parameter)."""
    return _dt.datetime.strptime(s, fmt)


def ntz_lit(value) -> Column:
    """A ``timestamp_ntz`` literal from a datetime or ISO text."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime.combine(value, _dt.time())
    return F.lit(value.isoformat(sep=" ")).cast(TimestampNTZType())


def date_list(start, end) -> Column:
    """Inclusive list of instants from ``start`` to ``end`` in fixed 24-hour steps.

    ``start``/``end`` are ``timestamp_ntz`` columns or ISO date(-time) text;
    both ends are included, as specified for the day loop; the list is empty if
    ``start`` comes after ``end``. A list that
    starts off midnight never matches a day key (see :func:`day_key`).
    """
    s = ntz_lit(start) if isinstance(start, str) else _as_ntz(start)
    e = ntz_lit(end) if isinstance(end, str) else _as_ntz(end)
    # Nothing lies between a start and an earlier end.
    last = F.greatest(s, e)
    return F.when(s <= e, F.sequence(s, last, F.expr("interval 24 hours"))) \
        .otherwise(F.array().cast("array<timestamp_ntz>"))


def day_key(c) -> Column:
    """The day a list instant names, or null when it is not a midnight."""
    c = _as_ntz(c)
    return F.when(c == F.date_trunc("day", c), F.to_date(c))


__all__ = [
    "PLANT_TZ", "PLANT_TIME_FORMATS", "parse_day_first", "parse_decimal_comma",
    "is_blank", "is_missing", "day_of", "to_utc", "from_utc", "parse_instant", "ntz_lit",
    "date_list", "day_key", "TimestampType",
]
