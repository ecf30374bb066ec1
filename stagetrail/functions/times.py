"""UTC instants at second precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagetrail.constants import TS_FORMAT
from stagetrail.functions.text import strip

# The form nearly all input has; the engine's own cast reads it.
_USUAL = r"^\d{4}-\d{2}-\d{2}(?:T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)?)?$"
# Everything else ISO allows: basic format, any separator, shortened clock, odd offsets.
_ISO = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,]\d+)?)?)?([+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?)?$"
)


def _from_parts(p: Column) -> Column:
    """Instant from the array [y, m, d, h, min, s, offset] of texts, absent parts empty."""
    two = lambda i: F.rpad(p[i], 2, "0")
    stamp = F.concat(p[0], F.lit("-"), p[1], F.lit("-"), p[2], F.lit("T"), two(3), F.lit(":"), two(4), F.lit(":"), two(5), F.lit("Z"))
    east = F.rpad(F.regexp_replace(F.regexp_replace(p[6], r"\.\d+$", ""), "[:+-]", ""), 6, "0")
    hours, minutes, seconds = (F.substring(east, i, 2).try_cast("int") for i in (1, 3, 5))
    shift = F.when((hours < 24) & (minutes < 60) & (seconds < 60), hours * 3600 + minutes * 60 + seconds)
    sign = F.when(F.startswith(p[6], F.lit("-")), -1).otherwise(1)
    return F.timestamp_seconds(F.unix_seconds(stamp.try_cast("timestamp")) - sign * shift)


def parse_ts(col: Column) -> Column:
    """ISO-8601 text to a UTC instant; naive is UTC, sub-seconds are cut, anything else is NULL."""
    text = strip(col.cast("string"))
    usual = F.date_trunc("second", text.try_cast("timestamp"))
    zoned = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    parts = F.split(F.regexp_replace(zoned, _ISO, r"$1|$3|$4|$5|$7|$8|$9"), r"\|", -1)
    # A one-element transform names the parts, so that they are split once.
    rare = F.transform(F.array(parts), _from_parts)[0]
    return F.when(F.rlike(text, F.lit(_USUAL)), usual).when(F.rlike(zoned, F.lit(_ISO)), rare)


def first_ts(columns: Sequence[Column]) -> Column:
    """First column that parses, in the given order."""
    return F.coalesce(*[parse_ts(c) for c in columns])


def iso_utc(ts: Column) -> Column:
    """Instant as fixed-width UTC text; the session zone is UTC."""
    return F.date_format(ts, TS_FORMAT)


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed whole days, cut towards zero (not calendar days)."""
    return F.timestamp_diff("DAY", start, end)


def whole_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", start, end)
