"""Safe casts for polymorphic document fields (ids stored as int or string)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# An id written as an integer, optionally with a zero fraction ("3", "-7", "3.0"):
# document stores hand numbers to a string column that way.
_INTEGRAL = r"^\s*-?\d+(\.0+)?\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_SCIENTIFIC = r"^\s*-?\d+(\.\d+)?[eE]\+?\d+\s*$"


def safe_bigint(c: Column | str, pretrimmed: bool = False, dtype: T.DataType | None = None) -> Column:
    """Integer id from a string/number column; NULL on NULL or on anything non-integral.

    "12" -> 12, "12.0" -> 12, "1.2E7" -> 12000000, "12.5" -> NULL, "x" -> NULL. With ``dtype``, the
    column's type, a numeric column is cast as a number and never by its printed form.
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.IntegralType):
        return col.cast("bigint")
    if isinstance(dtype, T.FractionalType):
        return F.when(col == F.floor(col.cast("double")), col.try_cast("bigint"))
    s = col if pretrimmed else F.trim(col.cast("string"))
    # a double prints as 1.2E7 from ten million on: exact as a decimal
    wide = F.when(s.rlike(_SCIENTIFIC), s.try_cast("decimal(38,6)"))
    return F.when(s.rlike(_INTEGRAL), F.regexp_replace(s, r"\.0+$", "").try_cast("bigint")).when(
        wide == F.floor(wide), wide.try_cast("bigint"))


def safe_double(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Number from a string or number column; NULL on NULL and on anything that is no number.

    "12", " 1.5 ", ".5", "1e3", "-inf" and "nan" are numbers; "1,5", "0x1F", "1d" and "" are not. With ``dtype``, the
    column's type, a numeric column is cast as a number.
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.NumericType):
        return col.cast("double")
    s = F.lower(F.trim(col.cast("string")))
    words = F.when(s.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf"))).when(
        s.isin("-inf", "-infinity"), F.lit(float("-inf"))).when(s == "nan", F.lit(float("nan")))
    return F.when(s.rlike(_NUMBER), s.try_cast("double")).otherwise(words)
