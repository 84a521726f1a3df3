"""Columns of the row with the greatest (date, id) of a group, by hash aggregation.

``max`` over a struct needs a sort aggregate: a struct is no fixed-width buffer. Here the order of a date and an id is packed
into one 64-bit number -- 17 bits of days, 46 bits of id, NULL above all values -- and every column is taken by
``max_by`` on it. Numbers, dates and flags are fixed-width as they are; a text of up to 14 bytes travels as two numbers.
Days outside 1790-2149, ids outside 0 .. 2^46 - 2 and longer texts raise an error rather than give a wrong row;
:func:`lapse.operators.latest.latest_per` without ``packed`` takes any values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_BITS, DAY_OFFSET = 46, 1 << 16
NULL_DAY, NULL_ID = (1 << 17) - 1, (1 << ID_BITS) - 1
HALF = 7  # bytes of a text in one number


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def _checked(value: Column, ok: Column, what: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(f"{what} is outside the range of a packed order")).cast("bigint"))


def order_key(day: Column, ident: Column) -> Column:
    """(date, id) as one number that orders alike, NULL as the greatest of either."""
    d = F.unix_date(day).cast("bigint") + _long(DAY_OFFSET)
    d = F.when(day.isNull(), _long(NULL_DAY)).otherwise(_checked(d, (d >= 0) & (d < NULL_DAY), "a date"))
    i = ident.cast("bigint")
    i = F.when(ident.isNull(), _long(NULL_ID)).otherwise(_checked(i, (i >= 0) & (i < _long(NULL_ID)), "an id"))
    return F.shiftleft(d, ID_BITS).bitwiseOR(i)


def key_day(key: Column) -> Column:
    d = F.shiftright(key, ID_BITS)
    return F.when(d != NULL_DAY, F.date_from_unix_date((d - _long(DAY_OFFSET)).cast("int")))


def key_id(key: Column) -> Column:
    i = key.bitwiseAND(_long(NULL_ID))
    return F.when(i != _long(NULL_ID), i)


def text_halves(text: Column) -> tuple[Column, Column]:
    """A text's first and second seven bytes, filled up with zeros, as numbers."""
    raw = F.encode(text, "UTF-8")
    padded = F.rpad(F.hex(raw), 4 * HALF, F.lit("0"))
    fits = F.length(raw) <= 2 * HALF

    def number(start: int) -> Column:
        return F.when(text.isNotNull(), _checked(F.conv(F.substring(padded, start, 2 * HALF), 16, 10).cast("bigint"), fits, "a text"))

    return number(1), number(1 + 2 * HALF)


def halves_text(first: Column, second: Column) -> Column:
    digits = F.concat(*[F.lpad(F.hex(x), 2 * HALF, F.lit("0")) for x in (first, second)])
    return F.decode(F.unhex(F.regexp_replace(digits, "(00)+$", "")), "UTF-8")


def argmax_columns(df: DataFrame, order: Sequence[str], columns: Sequence[str]) -> tuple[list[Column], list[Column]]:
    """(aggregates, outputs): ``columns`` of the row with the greatest ``order`` = (date, id).

    ``df.groupBy(...).agg(*aggregates).select(..., *outputs)``; the aggregates' names start with ``_m``.
    """
    day, ident = order
    kinds = {f.name: f.dataType for f in df.schema.fields}
    key = order_key(F.col(day), F.col(ident))
    aggregates, outputs = [F.max(key).alias("_mk")], []
    for n, c in enumerate(columns):
        if c == day:
            outputs.append(key_day(F.col("_mk")).alias(c))
        elif c == ident:
            outputs.append(key_id(F.col("_mk")).cast(kinds[c]).alias(c))
        elif isinstance(kinds[c], T.StringType):
            first, second = text_halves(F.col(c))
            aggregates += [F.max_by(first, key).alias(f"_m{n}a"), F.max_by(second, key).alias(f"_m{n}b")]
            outputs.append(halves_text(F.col(f"_m{n}a"), F.col(f"_m{n}b")).alias(c))
        else:
            aggregates.append(F.max_by(c, key).alias(f"_m{n}"))
            outputs.append(F.col(f"_m{n}").alias(c))
    return aggregates, outputs
