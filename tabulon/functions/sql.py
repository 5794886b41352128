"""SQL access to the date rule (U1 "registered for SQL").

``tabulon_lenient_date(text)`` is a SQL function whose body is the same rule as
``dates.lenient_date`` in SQL, so SQL users get the JVM-native path (Spark
inlines SQL functions into the plan).  ``tabulon_lenient_date_pandas(text)`` is
the vectorised pandas twin.  Tests check all three agree.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tabulon.functions.dates import (FIRST_VALID_DATE, ISO_BLANK, ISO_SHAPE, LAST_VALID_DATE, US_BLANK,
                                     US_SHAPE, lenient_date_udf)


def _lit(pattern: str) -> str:
    """A regex as a SQL string literal (backslashes escaped for the SQL parser)."""
    return "'" + pattern.replace("\\", "\\\\") + "'"


def _repaired(blank_pattern: str) -> str:
    return (f"CASE WHEN contains(t, ' ') THEN regexp_replace(t, {_lit(blank_pattern)}, '$1$2') "
            f"ELSE t END")


def lenient_date_sql_body() -> str:
    """A query over one row, each step a column of the one below it, so the rule is written once; Spark inlines it."""
    us_as_iso = ("concat(substring_index(us, '/', -1), '-', substring_index(us, '/', 1), '-', "
                 "substring_index(substring_index(us, '/', 2), '/', -1))")
    shaped = (f"CASE WHEN iso RLIKE {_lit(ISO_SHAPE)} THEN iso WHEN us RLIKE {_lit(US_SHAPE)} THEN {us_as_iso} END")
    return (f"SELECT CASE WHEN day BETWEEN DATE'{FIRST_VALID_DATE}' AND DATE'{LAST_VALID_DATE}' THEN day END "
            f"FROM (SELECT try_cast(shaped AS DATE) AS day FROM (SELECT {shaped} AS shaped FROM (SELECT "
            f"CASE WHEN contains(t, '-') THEN {_repaired(ISO_BLANK)} END AS iso, "
            f"CASE WHEN contains(t, '/') AND NOT contains(t, '-') THEN {_repaired(US_BLANK)} END AS us)))")


def register_sql_functions(spark: SparkSession) -> None:
    """Register the date rule for ``spark.sql`` in this session."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tabulon_lenient_date(t STRING) RETURNS DATE "
              f"RETURN {lenient_date_sql_body()}")
    spark.udf.register("tabulon_lenient_date_pandas", lenient_date_udf)
