"""Types of text columns, found by one aggregate over all rows.

Each column gets the first type of a lattice that holds all its values: bigint, double (which
also holds bigints), date, timestamp, boolean, else string; a column without values stays
string.  One pass counts, for every column, how many values each type holds, so the result does
not depend on how rows are spread over files, headers or tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: texts of each type, from the most special one ---------------------
_SHAPES = {
    "bigint": r"\A[+-]?[0-9]{1,19}\z",
    "double": r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?\z",
    "date": r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z",
    "timestamp_ntz": r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?\z",
    "boolean": r"(?i)\A(true|false)\z",
}
# ---------------------------------------------------------------------------------


def _as(column: Column, kind: str) -> Column:
    """The value as ``kind`` where its text has that type's shape and range, else NULL."""
    return F.when(column.rlike(_SHAPES[kind]), column.try_cast(kind))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def inferred_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """``{column: type}`` of text columns; one job, one row to the driver."""
    columns = columns if columns is not None else df.columns
    if not columns:
        return {}
    counts = []
    for i, name in enumerate(columns):
        value = _quoted(name)
        counts.append(F.count(value).alias(f"n{i}"))
        counts += [F.count(_as(value, kind)).alias(f"n{i}_{kind}") for kind in _SHAPES]
    row = df.agg(*counts).first()
    return {name: next((kind for kind in _SHAPES if row[f"n{i}"] and row[f"n{i}_{kind}"] == row[f"n{i}"]), "string")
            for i, name in enumerate(columns)}


def with_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns converted to the given types, the others as they are."""
    return df.select(*[_as(_quoted(c), types[c]).alias(c) if types.get(c, "string") != "string" else _quoted(c)
                       for c in df.columns])
