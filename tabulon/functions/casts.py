"""Lenient text -> declared type casts.

Policy: nothing is trimmed beyond what Spark's own cast trims.  A non-null text
that ends up NULL is a *reject*; rejects are counted per column by the caller
(``operators.conform``) or fail the job when ``on_error="fail"``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType, StringType, TimestampNTZType,
                               TimestampType)

from tabulon.functions.dates import lenient_date

# A whole number written with a fractional part of zeros, e.g. "3.0" from a file
# exported out of a floating-point column.
WHOLE_WITH_ZEROS = r"^(-?\d+)\.0*\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_long(c: Column | str) -> Column:
    text = _col(c)
    direct = text.try_cast("bigint")
    whole = F.when(text.rlike(WHOLE_WITH_ZEROS),
                   F.regexp_extract(text, WHOLE_WITH_ZEROS, 1).try_cast("bigint"))
    return F.coalesce(direct, whole)


def lenient_double(c: Column | str) -> Column:
    value = _col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def cast_text(c: Column | str, dtype: DataType) -> Column:
    """Text -> ``dtype`` under the lenient policy; unknown types use ``try_cast``."""
    text = _col(c)
    if isinstance(dtype, StringType):
        return text
    if isinstance(dtype, LongType):
        return lenient_long(text)
    if isinstance(dtype, (IntegerType, ShortType)):
        return lenient_long(text).try_cast(dtype)
    if isinstance(dtype, (DoubleType, FloatType)):
        return lenient_double(text).cast(dtype)
    if isinstance(dtype, DateType):
        return lenient_date(text)
    if isinstance(dtype, (TimestampNTZType, TimestampType)):
        return text.try_cast(dtype)
    if isinstance(dtype, BooleanType):
        return text.try_cast("boolean")
    return text.try_cast(dtype)


def is_reject(text: Column | str, value: Column | str) -> Column:
    """A value was present as text but could not be converted."""
    return _col(text).isNotNull() & _col(value).isNull()


def ntz_text(c: Column | str) -> Column:
    """``timestamp_ntz`` as ``yyyy-MM-dd HH:mm:ss.ffffff`` without touching a time zone.

    ``date_format`` would convert through the session time zone (and could shift
    a wall-clock time that falls in a daylight-saving gap); the plain string cast
    of a ``timestamp_ntz`` is zone-free, only its fraction needs padding.
    """
    text = _col(c).cast("string")
    fraction = F.when(text.contains("."), F.substring_index(text, ".", -1)).otherwise(F.lit(""))
    return F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(fraction, 6, "0"))
