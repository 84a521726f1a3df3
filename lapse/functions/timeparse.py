"""Time expressions: mixed-format parsing, ISO weeks, month buckets.

Timestamps in this library are wall-clock UTC ``TIMESTAMP_NTZ`` values, the
type the source parquet tables carry, so results do not depend on the
session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The string layouts accepted for event timestamps, tried in this
# order (ISO with 'Z', space separated, US month-first, ISO with offset).
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
)

_HAS_ZONE = r"(Z|[+-]\d{2}:?\d{2})$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant_to_utc_ntz(ltz: Column) -> Column:
    """Absolute instant -> UTC wall-clock TIMESTAMP_NTZ, independent of the session zone."""
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ltz), epoch)


# Shape of each layout in TIMESTAMP_FORMATS (same order), used to pick the one parse to run.
_SHAPES = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$",
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$",
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}[+-]\d{2}:?\d{2}$",
)


def _parse_one(s: Column, fmt: str) -> Column:
    if "X" in fmt or "'Z'" in fmt:
        zoned = fmt.replace("'Z'", "X")
        first = instant_to_utc_ntz(F.try_to_timestamp(s, F.lit(zoned)))
        if zoned.endswith("XXX"):  # also accept +hhmm offsets
            return F.coalesce(first, instant_to_utc_ntz(F.try_to_timestamp(s, F.lit(zoned[:-1]))))
        return first
    # zone-less: parse and cast back gives the same wall clock in any session zone
    return F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz")


def parse_mixed_timestamp(c: Column | str, formats=TIMESTAMP_FORMATS, pretrimmed: bool = False) -> Column:
    """Parse a string timestamp in any of ``formats``, then a lenient ISO parse.

    Unparsable values give NULL (never an error); the result is UTC wall clock
    (TIMESTAMP_NTZ). Strings that carry a zone are converted to UTC, strings
    without one are taken as UTC already. A cheap shape test picks the one
    layout to try, so a row costs one parse, not a chain of failed attempts.
    ``pretrimmed``: ``c`` is already a trimmed string column (project it once
    upstream so the branches share it).
    """
    s = _c(c) if pretrimmed else F.trim(_c(c).cast("string"))
    lenient = F.when(s.rlike(_HAS_ZONE), instant_to_utc_ntz(F.try_to_timestamp(s))) \
        .otherwise(s.try_cast("timestamp_ntz"))
    if tuple(formats) != TIMESTAMP_FORMATS:  # custom layouts: try them in order
        return F.coalesce(*[_parse_one(s, f) for f in formats], lenient)
    expr = None
    for shape, fmt in zip(_SHAPES, formats):
        cond = s.rlike(shape)
        expr = F.when(cond, _parse_one(s, fmt)) if expr is None else expr.when(cond, _parse_one(s, fmt))
    return expr.otherwise(lenient)


def iso_week_key(c: Column | str) -> Column:
    """'<ISO week-year>-W<ISO week>' without zero padding (e.g. '2024-W1')."""
    ts = _c(c)
    return F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"),
                    F.weekofyear(ts).cast("string"))


def ntz_literal(value: str | _dt.date | _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (parameters such as ``as_of``)."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = value if " " in value else value + " 00:00:00"
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def as_datetime(value: str | _dt.date | _dt.datetime | None) -> _dt.datetime:
    """A report's reference time; None is the current time (UTC)."""
    if value is None:
        return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, _dt.datetime):
        return value
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    return _dt.datetime.fromisoformat(value)


def month_floor_minus(as_of, months: int) -> _dt.datetime:
    """DATE_TRUNC('month', as_of - months) computed once for a parameter."""
    d = as_datetime(as_of)
    y, m = d.year, d.month - months
    while m <= 0:
        m += 12
        y -= 1
    return _dt.datetime(y, m, 1)
