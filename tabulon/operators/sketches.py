"""Column profiles that can be united (A2, A8, A9 for growing tables).

``column_profile`` counts distinct values exactly and has to see all rows again after every
load.  A sketch row holds, per column and group (a file, a day, a version), the exact counts and ends and Spark's
own mergeable sketches: HyperLogLog for distinct values and KLL for quantiles of numbers.
Sketch rows are small and stored; uniting them costs nothing that grows with the data, so a new file
costs a pass over its own rows only.

Error: distinct values within about 1.04 / sqrt(2 ** LG_K) (0.8 %), quantile ranks within about 1 %.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def sketch(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """``(by..., column_name, n_rows, n_nulls, min_value, max_value, min_length, max_length, distinct, quantiles)``.

    One pass and one aggregate over all columns; every part of it combines map-side.  ``min_value`` and ``max_value`` are of numbers,
    lengths are of text.
    """
    by = by or []
    kinds = dict(df.dtypes)
    none = lambda kind: F.lit(None).cast(kind)
    aggregates = []
    for i, c in enumerate(columns):
        column = F.col("`" + c.replace("`", "``") + "`")
        number, text = kinds[c] in _NUMBERS, kinds[c] == "string"
        value = column.cast("double")
        hashed = column if text else column.cast("string")
        aggregates += [
            F.count(column).alias(f"n{i}"),
            F.hll_sketch_agg(hashed, LG_K).alias(f"d{i}"),
            *([F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"),
               F.kll_sketch_agg_double(value).alias(f"q{i}")] if number else []),
            *([F.min(F.length(column)).alias(f"s{i}"), F.max(F.length(column)).alias(f"l{i}")] if text else [])]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *aggregates)
    each = []
    for i, c in enumerate(columns):
        number, text = kinds[c] in _NUMBERS, kinds[c] == "string"
        each.append(F.struct(
            F.lit(c).alias("column_name"), F.col("n_rows"), (F.col("n_rows") - F.col(f"n{i}")).alias("n_nulls"),
            (F.col(f"lo{i}") if number else none("double")).alias("min_value"),
            (F.col(f"hi{i}") if number else none("double")).alias("max_value"),
            (F.col(f"s{i}") if text else none("int")).alias("min_length"),
            (F.col(f"l{i}") if text else none("int")).alias("max_length"),
            F.col(f"d{i}").alias("distinct"), (F.col(f"q{i}") if number else none("binary")).alias("quantiles")))
    return wide.select(*by, F.explode(F.array(*each)).alias("s")).select(*by, "s.*")


def unite(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketch rows of several groups as one per column (and ``by``)."""
    return sketches.groupBy(*(by or []), "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"))


def profile(sketches: DataFrame) -> DataFrame:
    """What sketch rows say: the exact columns, ``n_distinct_estimate`` and the ``median`` of numbers."""
    # a sketch of no values has no quantiles, and asking it for one fails
    median = F.when(F.col("min_value").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5)))
    return sketches.select(*[c for c in sketches.columns if c not in ("distinct", "quantiles")],
                           F.hll_sketch_estimate("distinct").alias("n_distinct_estimate"), median.alias("median"))
