"""Inspection and profiling.

Per-column work is done in one job by unpivoting the columns into
``(column_name, value)`` rows.  Top-k per column keeps ``k`` candidates while a
task reads its batches and ranks those, so a column with billions of distinct
values is never sorted, and sends only ``k`` rows per map task to the final ranking.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.operators.ranking import free_name, global_rank
from tabulon.session import ship_package


def rows_per_group(df: DataFrame, by: str | list[str]) -> DataFrame:
    """A1 per file / source: ``(by..., n_rows)``."""
    by = [by] if isinstance(by, str) else by
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def as_text_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


def unpivot_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    return as_text_columns(df, columns).unpivot([], columns, "column_name", "value")


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """A2: ``(column_name, value)`` for every distinct value of every column."""
    return unpivot_text(df, columns).distinct()


def distinct_lengths(df: DataFrame, column: str) -> DataFrame:
    """The set of text lengths of one column."""
    return df.select(F.length(F.col(column).cast("string")).alias("length")).distinct()


_FAMILIES = {  # columns of one family are unpivoted together, as this type; others are compared as text
    "bigint": ("tinyint", "smallint", "int", "bigint"),
    "double": ("float", "double"),
    "timestamp_ntz": ("timestamp_ntz",),
    "timestamp": ("timestamp",),  # an instant: the repeated hour of a zone holds two of each wall time
    "date": ("date",),
    "boolean": ("boolean",),
}


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, nulls, distinct values and min/max text length per column.

    Columns are unpivoted by type family into plain typed values, so distinct
    counting compares native values and no number or time is rendered as
    text.  Lengths are reported for string columns only (the text form of
    numbers is an engine choice, not data).
    """
    columns = columns or df.columns
    kinds = dict(df.dtypes)
    families: dict[str, list[str]] = {}
    for c in columns:
        family = next((f for f, own in _FAMILIES.items() if kinds[c] in own), "string")
        families.setdefault(family, []).append(c)
    out = None
    for family, own in families.items():
        values = df.select(*[F.col(c).cast(family).alias(c) for c in own]).unpivot([], own, "column_name", "value")
        text = [c for c in own if kinds[c] == "string"]
        length = F.when(F.col("column_name").isin(text), F.length("value")) if text else F.lit(None).cast("int")
        part = values.groupBy("column_name").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("value").isNull()).alias("n_nulls"),
            F.count_distinct("value").alias("n_distinct"),
            F.min(length).alias("min_length"), F.max(length).alias("max_length"))
        out = part if out is None else out.unionByName(part)
    return out


def _candidates(df: DataFrame, columns: list[str], k: int, orders: list[list[tuple[str, str]]]) -> DataFrame:
    """``(column_name, value)``: of each task, the distinct values in one of the first ``k`` places by some order.

    An order names ``value`` and ``length`` with their directions.  A task holds a batch of rows and at most ``k``
    values for each column and order, however many rows it reads; sorting them all would take memory for each.
    """
    ship_package(df.sparkSession)
    texts = df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("string").alias(f"c{i}") for i, c in enumerate(columns)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {(i, j): pa.array([], pa.string()) for i in range(len(columns)) for j in range(len(orders))}
        for batch in batches:
            for i in range(len(columns)):
                new = pc.unique(batch.column(i).drop_null().cast(pa.string()))
                for j, order in enumerate(orders):
                    values = pc.unique(pa.concat_arrays([held[i, j], new]))
                    if len(values) > k:
                        table = pa.table({"value": values, "length": pc.utf8_length(values)})
                        values = values.take(pc.select_k_unstable(table, k, order))
                    held[i, j] = values
        for (i, _), values in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([columns[i]] * len(values), pa.string()), values],
                                             names=["column_name", "value"])

    return texts.mapInArrow(run, "column_name string, value string")


def _least_distinct(values: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The first ``k`` distinct rows of each group by ``order`` (all columns but ``by``), with their ``rank``.

    Each task keeps its rows of the ``k`` least distinct places before anything is shuffled (a group limit on
    ``dense_rank``), then copies go, then the few rows left are ranked.  Tasks' rows are told apart
    by the task's number, so copies of one value in a third of all rows do not meet in one task.
    """
    task = free_name(values, "_task")
    spread = values.withColumn(task, F.spark_partition_id())
    place = F.dense_rank().over(Window.partitionBy(*by, task).orderBy(*order))
    few = spread.withColumn("rank", place).where(F.col("rank") <= k).drop(task, "rank").distinct()
    return (few.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
            .where(F.col("rank") <= k))


def column_samples(df: DataFrame, columns: list[str] | None = None, k: int = 10) -> DataFrame:
    """A9 sample: the first ``k`` distinct non-null values per column, by value."""
    values = _candidates(df, columns or df.columns, k, [[("value", "ascending")]])
    return _least_distinct(values, ["column_name"], ["value"], k)


def extreme_lengths(df: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """L2: the ``k`` shortest and ``k`` longest distinct values per column, from one scan.

    Ties in length are broken by the value, so the result is deterministic.
    """
    length = F.length("value")
    ends = F.explode(F.array(F.struct(F.lit("shortest").alias("end"), length.alias("by_length")),
                             F.struct(F.lit("longest").alias("end"), (-length).alias("by_length"))))
    orders = [[("length", by), ("value", "ascending")] for by in ("ascending", "descending")]
    values = (_candidates(df, columns, k, orders)
              .select("column_name", "value", ends.alias("e")).select("column_name", "value", "e.end", "e.by_length"))
    least = _least_distinct(values, ["column_name", "end"], ["by_length", "value"], k)
    return least.select("column_name", "end", "rank", "value", F.abs("by_length").alias("length"))


def long_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose ``column`` holds more than ``n`` characters."""
    return df.where(F.length(F.col(column)) > n)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """P8."""
    return df.where(F.col(column).isNotNull())


def values_desc(df: DataFrame, column: str, n: int | None = None, tie: list[str] | None = None) -> DataFrame:
    """L4: all non-null values as integers, largest first; with ``n`` only the top ``n``.

    The full list is a range-partitioned sort; with ``n`` it is a per-partition
    top-n plus a final merge.
    """
    tie = tie or []
    out = (df.where(F.col(column).isNotNull())
           .select(*tie, F.col(column).cast("long").alias(column)))
    ordered = out.orderBy(F.col(column).desc(), *tie)
    return ordered if n is None else ordered.limit(n)


def values_ranked(df: DataFrame, column: str, tie: list[str] | None = None, out: str = "rank") -> DataFrame:
    """L4 with a checked order: all non-null values as integers, with their place in the descending order.

    Ties are broken by ``tie``.  The rank is counted over range partitions, so no task sees all rows.
    """
    tie = tie or []
    values = df.where(F.col(column).isNotNull()).select(*tie, F.col(column).cast("long").alias(column))
    return global_rank(values, [F.col(column).desc(), *tie], out)


def preview(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """L1: the first ``n`` rows by key, repeatable."""
    return df.orderBy(*keys).limit(n)


def count_flags(df: DataFrame, flag: str, by: list[str]) -> DataFrame:
    """A10: ``count_if(flag)`` per group, with the group size."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"),
                               F.count_if(F.col(flag)).alias("n_flagged"))
