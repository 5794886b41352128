"""Positions and running totals in one global order, without a single-task window.

``row_number() OVER (ORDER BY ...)`` sends every row to one task.  Here the rows
are range-partitioned and sorted, written to the shared folder with their place,
and each range needs only the count (or sum) of the ranges before it: a table
with one row per range, whatever the number of rows.

Equal order keys stay in one range, so the order should end in columns that tell
rows apart; otherwise the rows of one key share a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.session import stage

# A range's rows are numbered by ``monotonically_increasing_id``: the range above this bit, the row below it.
_ROW_BITS = 33
# Above this many ranges their table is joined without a broadcast.
BROADCAST_MAX_RANGES = 100_000


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with leading underscores until ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _in_order(df: DataFrame, order: list[str | Column], at: str) -> DataFrame:
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranged.withColumn(at, F.monotonically_increasing_id()), "in-order")


def _earlier(rows: DataFrame, block: str, values: dict[str, Column]) -> DataFrame:
    """Per range, the sum of each value over all earlier ranges.

    A row per range, so at most ``spark.sql.shuffle.partitions`` rows: broadcast up to a bound on that number.
    """
    sums = rows.groupBy(block).agg(*(F.sum(v).alias(name) for name, v in values.items()))
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)  # metadata: one row per range
    sums = sums.select(block, *(F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in values))
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.broadcast(sums) if ranges <= BROADCAST_MAX_RANGES else sums


def global_rank(df: DataFrame, order: list[str | Column], out: str = "rank") -> DataFrame:
    """``df`` with the 1-based position of each row in the order (as ``row_number`` over all rows).

    One range shuffle; the position within a range is read off the row id, so
    there is no window over the rows.  An empty table gives an empty table.
    """
    at = free_name(df, "_at")
    block, before = free_name(df, "_block"), free_name(df, "_before")
    rows = _in_order(df, order, at).withColumn(block, F.shiftright(at, _ROW_BITS))
    joined = rows.join(_earlier(rows, block, {before: F.lit(1)}), block)
    place = F.col(at) - F.shiftleft(F.col(block), _ROW_BITS) + F.col(before) + 1
    return joined.select(*df.columns, place.cast("long").alias(out))


def running_total(df: DataFrame, order: list[str | Column], value: str, out: str = "running",
                  rank: str | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` (a long without nulls) over each row and all rows before it in the order.

    The window runs within a range only; ranges are of bounded size.  ``rank``: a column for the position as well.
    """
    at = free_name(df, "_at")
    block, before, place = free_name(df, "_block"), free_name(df, "_before"), free_name(df, "_place")
    rows = _in_order(df, order, at).withColumn(block, F.shiftright(at, _ROW_BITS))
    within = Window.partitionBy(block).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = (rows.withColumn(out, F.sum(value).over(within))
              .join(_earlier(rows, block, {before: F.col(value), place: F.lit(1)}), block))
    position = F.col(at) - F.shiftleft(F.col(block), _ROW_BITS) + F.col(place) + 1
    return joined.select(*df.columns, (F.col(out) + F.col(before)).cast("long").alias(out),
                         *([position.cast("long").alias(rank)] if rank else []))
