"""Date parsing from text.

``lenient_date`` (F2) is the default: pure Catalyst expressions, so it stays in
whole-stage codegen and needs no Python worker.  ``lenient_date_udf`` (U1) is a
vectorised pandas twin used as a cross-check and for SQL users who want the
pandas parser itself.

Rule of ``lenient_date``:

* NULL or empty text -> NULL;
* text containing ``-`` is read as year-month-day, else text containing ``/`` as
  month/day/year; anything else -> NULL (and is counted by ``no_separator``);
* years have exactly four digits, month and day one or two; one blank before a
  one-digit day is tolerated; nothing is trimmed;
* impossible dates and dates outside the range a nanosecond timestamp can hold
  (the range below) -> NULL, so a typo such as year 3012 never reaches the table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DateType

# --- fixed values ---------------------------------------------------------------
# Inclusive range of calendar dates representable as a nanosecond timestamp at
# midnight; dates outside it become NULL.
FIRST_VALID_DATE = "1677-09-22"
LAST_VALID_DATE = "2262-04-11"
# Accepted shapes after the blank-before-day repair (``\z``: no line break may follow).
# Repairs: one blank before a one-digit day.
ISO_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}\z"
US_SHAPE = r"^\d{1,2}/\d{1,2}/\d{4}\z"
ISO_BLANK = r"^(\d{4}-\d{1,2}-) ([1-9])\z"
US_BLANK = r"^(\d{1,2}/) ([1-9]/\d{4})\z"
# ---------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _in_range(d: Column) -> Column:
    return F.when(d.between(F.lit(FIRST_VALID_DATE).cast("date"),
                            F.lit(LAST_VALID_DATE).cast("date")), d)


def _repair_blank(text: Column, pattern: str) -> Column:
    """Drop one blank before a one-digit day; the regex only runs on text with a blank."""
    return F.when(text.contains(" "), F.regexp_replace(text, pattern, "$1$2")).otherwise(text)


def _iso(text: Column) -> Column:
    repaired = _repair_blank(text, ISO_BLANK)
    # The shape check pins the text to y-m-d digits, so Spark's own (fast)
    # string-to-date cast reads exactly what the pattern "yyyy-M-d" would.
    return F.when(repaired.rlike(ISO_SHAPE), repaired.try_cast("date"))


def _us(text: Column) -> Column:
    repaired = _repair_blank(text, US_BLANK)
    as_iso = F.concat(F.substring_index(repaired, "/", -1), F.lit("-"),
                      F.substring_index(repaired, "/", 1), F.lit("-"),
                      F.substring_index(F.substring_index(repaired, "/", 2), "/", -1))
    return F.when(repaired.rlike(US_SHAPE), as_iso.try_cast("date"))


def lenient_date(c: Column | str) -> Column:
    """Mixed ISO / US text -> DATE, NULL when it cannot be read (F2)."""
    text = _col(c)
    return _in_range(any_date(text))


def any_date(c: Column | str) -> Column:
    """``lenient_date`` before the range check, for callers that apply ``in_range`` to the parsed column."""
    text = _col(c)
    return F.when(text.contains("-"), _iso(text)).when(text.contains("/"), _us(text))


def in_range(c: Column | str) -> Column:
    """The date, NULL outside the range."""
    return _in_range(_col(c))


def no_separator(c: Column | str) -> Column:
    """True for non-empty text with neither ``-`` nor ``/`` (F2's warning case)."""
    text = _col(c)
    return (text.isNotNull() & (text != "") & ~text.contains("-") & ~text.contains("/"))


def strict_date(c: Column | str, name: str | None = None) -> Column:
    """the F2 rule, but unreadable non-null text fails the job."""
    text = _col(c)
    parsed = lenient_date(text)
    label = name or "date"
    return F.when(text.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"unreadable {label}: '"), text, F.lit("'")))
                  .cast("date")).otherwise(parsed)


def single_format_date(c: Column | str, fmt: str = "MM/dd/yyyy") -> Column:
    """one Spark pattern, NULL on failure (``MM``/``dd`` need two digits)."""
    return F.try_to_date(_col(c), fmt)


def strict_single_format_date(c: Column | str, name: str | None = None) -> Column:
    """month/day/year only (one or two digits), failing on anything else."""
    text = _col(c)
    parsed = _in_range(_us(text))
    label = name or "date"
    return F.when(text.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"unreadable {label}: '"), text, F.lit("'")))
                  .cast("date")).otherwise(parsed)


def text_length(c: Column | str) -> Column:
    """characters, trailing blanks included."""
    return F.length(_col(c))


@pandas_udf(DateType())
def lenient_date_udf(s: pd.Series) -> pd.Series:
    """The F2 rule evaluated by pandas' own parser, one Arrow batch at a time."""
    has_dash = s.str.contains("-", regex=False, na=False).astype(bool)
    has_slash = (~has_dash) & s.str.contains("/", regex=False, na=False).astype(bool)
    out = pd.Series(pd.NaT, index=s.index, dtype="datetime64[ns]")
    if has_dash.any():
        out[has_dash] = pd.to_datetime(s[has_dash], format="%Y-%m-%d", errors="coerce")
    if has_slash.any():
        out[has_slash] = pd.to_datetime(s[has_slash], format="%m/%d/%Y", errors="coerce")
    return out.dt.date.where(out.notna(), None)
