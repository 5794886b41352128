"""Uniqueness, duplicates and data-quality gates.

Skew: a single key may hold a large share of all rows.  Every operator here
either aggregates (partial aggregation before the shuffle shrinks a hot key to
one row per map task) or uses ``row_number() = 1``, which Spark executes with a
per-partition group limit before the shuffle, so a hot key never lands whole in
one task.  The duplicate report joins on a row number, which is unique, so it
has no skew either.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.operators.ranking import free_name
from tabulon.session import stage


class GateFailed(AssertionError):
    """A data-quality gate did not pass."""


def _desc(order: list[str | Column]) -> list[Column]:
    return [(F.col(o) if isinstance(o, str) else o).desc() for o in order]


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key (NULL is one value, as in ``dropDuplicates``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def uniqueness_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """A3/A4 in one shuffle: rows, distinct keys, duplicated keys, excess rows."""
    per_key = key_counts(df, keys)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n_excess_rows"),
    ).withColumn("is_unique", F.col("n_duplicate_keys") == 0)


def drop_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """A3: one arbitrary row per key (only the row count is deterministic)."""
    return df.dropDuplicates(keys)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return key_counts(df, keys).where(F.col("n") > 1)


def repeated_keys(df: DataFrame, by: str, keys: list[str]) -> DataFrame:
    """Q1 per extract: keys held by more than one row of the same ``by`` (whatever part files hold them)."""
    return df.groupBy(by, *keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: list[str], sample: int = 20, where: str = "input") -> None:
    """Q1: fail with up to ``sample`` offending keys."""
    bad = duplicate_keys(df, keys).limit(sample).collect()
    if bad:
        raise GateFailed(f"{where}: key {keys} not unique, e.g. {[tuple(r) for r in bad]}")


def keep_last(df: DataFrame, keys: list[str], order: list[str | Column],
              nulls_equal: bool = True) -> DataFrame:
    """A5: the last row per key by ``order`` (which must be unique within a key).

    ``nulls_equal=True`` treats NULL keys as one key (pandas ``duplicated``);
    ``False`` passes every NULL-key row through (SQL ``ON`` equality never
    matches NULL).
    """
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*_desc(order)))
    if nulls_equal:
        return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    nulls = df.where(any_null)
    ranked = df.where(~any_null).withColumn("_rn", rn).where("_rn = 1").drop("_rn")
    return ranked.unionByName(nulls)


def _told_apart(df: DataFrame, identity: list[str] | None) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that identify a row: ``identity``, or else a row number, fixed by writing it out."""
    if identity:
        return df, identity
    rid = free_name(df, "_rid")
    return stage(df.withColumn(rid, F.monotonically_increasing_id()), "numbered"), [rid]


def _last_rows(rows: DataFrame, keys: list[str], order: list[str], identity: list[str]) -> DataFrame:
    """Identity of the last row per key: a maximum that is combined map-side, so only narrow winners of each task move."""
    last = F.max(F.struct(*order, *identity))
    return rows.groupBy(*keys).agg(last.alias("_last")).select(*[F.col(f"_last.{c}").alias(c) for c in identity])


def duplicate_rows(df: DataFrame, keys: list[str], order: list[str] | None = None,
                   identity: list[str] | None = None) -> DataFrame:
    """Every row that is not the last of its key (the rows ``keep_last`` drops).

    Rows that tie on key and order, exact duplicates among them, are told apart
    by their identity, the last key of the order; so ``order`` need not be
    unique and may be left out (position decides).  ``identity`` names columns of ``df`` that are unique,
    not null, and the same on every read (``files.with_row_identity``); they are not returned.  Without it the rows
    are numbered and written out first.  Whole rows are shuffled once, to be joined with the winners.
    """
    rows, told = _told_apart(df, identity)
    kept = rows.join(_last_rows(rows, keys, order or [], told), told, "left_anti")
    return kept.drop(*told)


def flag_duplicates(df: DataFrame, keys: list[str], order: list[str] | None = None,
                    flag: str = "is_duplicate", identity: list[str] | None = None) -> DataFrame:
    """Each row with a boolean: True when a later row has the same key (A10 input); ties and ``identity`` as in A6."""
    rows, told = _told_apart(df, identity)
    last = _last_rows(rows, keys, order or [], told).withColumn("_last", F.lit(True))
    joined = rows.join(last, told, "left")
    return joined.select(*[c for c in df.columns if c not in (identity or [])], F.col("_last").isNull().alias(flag))


def max_lengths(df: DataFrame, columns: list[str]) -> DataFrame:
    """``max(length(c))`` of every listed column, one aggregate pass."""
    return df.agg(*[F.max(F.length(F.col(c))).alias(c) for c in columns])


def length_gate(df: DataFrame, columns: list[str], limit: int = 10,
                subject: str | None = None) -> DataFrame:
    """Q2: one row per column ``(gate, subject, column_name, value, passed)``.

    An all-NULL column passes (its maximum is NULL).
    """
    wide = max_lengths(df, columns)
    stacked = wide.unpivot([], columns, "column_name", "value")
    return stacked.select(
        F.lit("date_text_length").alias("gate"),
        F.lit(subject).cast("string").alias("subject"),
        "column_name",
        F.col("value").cast("long").alias("value"),
        F.coalesce(F.col("value") <= limit, F.lit(True)).alias("passed"))


def assert_gates(report: DataFrame) -> None:
    bad = report.where(~F.col("passed")).limit(20).collect()
    if bad:
        raise GateFailed("gates failed: " + "; ".join(
            f"{r['gate']}[{r['subject']}:{r['column_name']}]={r['value']}" for r in bad))


def gate_rows(df: DataFrame, keys: list[str], schema_names: list[str],
              date_text_columns: list[str], subject: str, limit: int = 10) -> DataFrame:
    """Q1–Q5 for one input as rows ``(gate, subject, column_name, value, passed)``.

    * ``key_unique``: number of keys held by more than one row (Q1);
    * ``date_text_length``: max text length per date column (Q2);
    * ``column_set``: number of columns outside / missing from the declared set (Q3, P4);
    * ``non_empty``: row count (Q5).
    Two aggregate jobs in total, whatever the number of columns.
    """
    spark = df.sparkSession
    summary = uniqueness_summary(df, keys)
    uniq = summary.select(F.lit("key_unique").alias("gate"), F.lit(subject).alias("subject"),
                          F.lit(",".join(keys)).alias("column_name"),
                          F.col("n_duplicate_keys").alias("value"),
                          (F.col("n_duplicate_keys") == 0).alias("passed"))
    rows = summary.select(F.lit("non_empty").alias("gate"), F.lit(subject).alias("subject"),
                          F.lit("*").alias("column_name"), F.col("n_rows").alias("value"),
                          (F.col("n_rows") > 0).alias("passed"))
    have = {c.lower() for c in df.columns}
    want = {c.lower() for c in schema_names}
    n_diff = len(have ^ want)
    cols = spark.createDataFrame([("column_set", subject, "*", n_diff, n_diff == 0)],
                                 "gate string, subject string, column_name string, value long, passed boolean")
    parts = [uniq, rows, cols]
    if date_text_columns:
        parts.append(length_gate(df, date_text_columns, limit, subject))
    return reduce(lambda a, b: a.unionByName(b), parts)


def length_histograms(left: DataFrame, right: DataFrame, column: str,
                      names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Q6: value-length histograms of one column read two ways, side by side.

    ``(length, n_<left>, n_<right>, differs)``: a quote-aware reader and a naive
    one disagree exactly where quoted fields hold separators or line breaks.
    """
    a, b = names
    ha = left.groupBy(F.length(F.col(column)).alias("length")).agg(F.count(F.lit(1)).alias(f"n_{a}"))
    hb = right.groupBy(F.length(F.col(column)).alias("length")).agg(F.count(F.lit(1)).alias(f"n_{b}"))
    both = ha.join(hb, ha["length"].eqNullSafe(hb["length"]), "full")
    return both.select(F.coalesce(ha["length"], hb["length"]).alias("length"),
                       F.coalesce(F.col(f"n_{a}"), F.lit(0)).alias(f"n_{a}"),
                       F.coalesce(F.col(f"n_{b}"), F.lit(0)).alias(f"n_{b}"),
                       (F.coalesce(F.col(f"n_{a}"), F.lit(0)) != F.coalesce(F.col(f"n_{b}"), F.lit(0)))
                       .alias("differs"))


def content_fingerprint(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Q6: ``(by..., n_rows, sum_a, sum_b)``, the same for two reads that hold the same rows in whatever order.

    Two sums of 64-bit row hashes and the count identify a multiset of rows, repeated rows included; one
    partial aggregate, no join of the reads.  NULL and the empty text differ.
    """
    told = [F.col(c).isNull() for c in columns]  # the hash itself passes over NULL
    first = F.xxhash64(*columns, *told)
    second = F.xxhash64(F.lit(7), *told, *reversed(columns))
    total = lambda h: F.sum(h.cast("decimal(38,0)"))
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n_rows"), total(first).alias("sum_a"),
                                       total(second).alias("sum_b"))


def same_content(left: DataFrame, right: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Q6: ``(by..., n_left, n_right, equal)`` per group: whether two reads hold the same rows."""
    a = content_fingerprint(left, columns, by).withColumnsRenamed({"n_rows": "n_left", "sum_a": "la", "sum_b": "lb"})
    b = content_fingerprint(right, columns, by).withColumnsRenamed({"n_rows": "n_right", "sum_a": "ra", "sum_b": "rb"})
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    equal = F.coalesce((F.col("n_left") == F.col("n_right")) & (F.col("la") == F.col("ra")) & (F.col("lb") == F.col("rb")), F.lit(False))
    return a.join(b, by, "full").select(*by, n(F.col("n_left")).alias("n_left"), n(F.col("n_right")).alias("n_right"), equal.alias("equal"))
