"""Upsert of an update set into a keyed table.

``MERGE INTO t USING s ON t.k = s.k WHEN MATCHED THEN UPDATE SET * WHEN NOT
MATCHED THEN INSERT *`` replaces whole rows, so its result is

    (target rows whose key matches no source row)  UNION ALL  (all source rows)

i.e. a left anti join plus a union: one shuffle of each side on the key (or
none for the update side when AQE sees it is small and broadcasts it).  The
result is a new DataFrame; publishing it as a table version is the caller's
job (``sinks.tables``), so a failed merge never leaves a half-written table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.conform import conform_to_target


class MergeCardinalityError(RuntimeError):
    """Several source rows match the same target row."""


def _no_null_key(keys: list[str]):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _nullable(df: DataFrame, keys: list[str]) -> bool:
    return any(df.schema[k].nullable for k in keys)


def cardinality_violations(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source keys held by several source rows *and* present in the target.

    Duplicated source keys that match nothing are legal (both rows are
    inserted), and a NULL key never matches.
    """
    dup = (source.where(_no_null_key(keys)).groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("n_source_rows"))
           .where(F.col("n_source_rows") > 1))
    # The target streams against the (usually small) set of duplicated keys, so AQE can broadcast that set
    # instead of shuffling the target's keys; the counts travel along, so the source is aggregated once.
    return target.select(*keys).join(dup, keys).distinct().select(*keys, "n_source_rows")


def check_cardinality(target: DataFrame, source: DataFrame, keys: list[str],
                      sample: int = 20) -> None:
    bad = cardinality_violations(target, source, keys).limit(sample).collect()
    if bad:
        raise MergeCardinalityError(
            "cannot merge: multiple source rows match the same target row for keys "
            f"{[tuple(r[k] for k in keys) for r in bad]}")


def upsert(target: DataFrame, source: DataFrame, keys: list[str] | tuple[str, ...], *,
           check: bool = True, delete_missing: bool = False,
           partitions: int | None = None, key_side: DataFrame | None = None) -> DataFrame:
    """J1 (update all columns, insert the rest), J3 with ``delete_missing``.

    The source is first conformed to the target's schema by name (J4: a BIGINT
    key into an INT column is narrowed, overflow fails).  With ``check`` the
    cardinality rule J2 is enforced before anything is produced; pass
    ``check=False`` when the caller has already proven source keys unique.
    ``partitions``: the bucket count of a target read as a bucketed table; the
    source is hash-partitioned the same way once, so the anti join shuffles
    neither side again and every output task holds exactly one bucket.
    NULL keys follow SQL: they never match, so such source rows are inserted and
    such target rows kept (J5).  ``key_side``: the distinct keys of the source, where the
    caller has them cheaper than from the source itself.  The source is read up to three times (check,
    key side of the anti join, union): stage an expensive source first.
    """
    keys = list(keys)
    src = conform_to_target(source, target.schema)
    if partitions:
        # rows without a key match nothing: they stay spread instead of meeting in one bucket's task
        keyed = src.where(_no_null_key(keys)).repartition(partitions, *keys)
        src = keyed.unionByName(src.where(~_no_null_key(keys))) if _nullable(src, keys) else keyed
    if check:
        check_cardinality(target, src, keys)
    if delete_missing:
        return src
    if key_side is not None:
        key_side = conform_to_target(key_side, target.select(*keys).schema)
        if partitions:
            key_side = key_side.repartition(partitions, *keys)
    else:
        key_side = src.select(*keys)
    if check:
        # A general update set may repeat a key many times; deduplicating the key
        # side (combined map-side) keeps a hot key from skewing the anti join.
        # Ingest passes check=False with keys already unique.
        key_side = key_side.distinct()
    kept = target.join(key_side, keys, "left_anti")
    return kept.unionByName(src)
