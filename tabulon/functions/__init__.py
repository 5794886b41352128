"""Column-level functions: lenient dates (F1–F6, U1) and lenient casts."""

from tabulon.functions.casts import cast_text, is_reject, lenient_double, lenient_long
from tabulon.functions.dates import (lenient_date, lenient_date_udf, no_separator,
                                     single_format_date, strict_date, strict_single_format_date,
                                     text_length)

__all__ = ["cast_text", "is_reject", "lenient_double", "lenient_long", "lenient_date",
           "lenient_date_udf", "no_separator", "single_format_date", "strict_date",
           "strict_single_format_date", "text_length"]
