"""Scalar column functions (built-in Spark expressions only)."""
from helioframe.functions.timefns import (  # noqa: F401
    PLANT_TZ, PLANT_TIME_FORMATS, parse_day_first, parse_decimal_comma, is_blank,
    day_of, to_utc, from_utc, parse_instant, ntz_lit, date_list, day_key,
)
from helioframe.functions.text import (  # noqa: F401
    decode_path, basename, tag_from_path, normalise_tag,
)
