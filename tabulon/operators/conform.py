"""Schema conformance (P1–P4, P6, P9, P10, P12, P2 via ``functions.casts``).

Column names resolve case-insensitively, as Spark does by default.  Extra
columns are reported (mode ``report``) or fail (mode ``strict``); a missing
declared column always fails.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tabulon.functions.casts import cast_text, is_reject
from tabulon.functions.dates import any_date, in_range


class SchemaMismatch(ValueError):
    """Declared and actual column sets disagree."""


def column_diff(columns: list[str], schema: StructType) -> tuple[list[str], list[str]]:
    """``(extra, missing)`` between actual ``columns`` and the schema, case-insensitive."""
    have = {c.lower() for c in columns}
    want = {n.lower() for n in schema.names}
    extra = [c for c in columns if c.lower() not in want and not c.startswith("_")]
    missing = [n for n in schema.names if n.lower() not in have]
    return extra, missing


def check_columns(columns: list[str], schema: StructType, mode: str = "report",
                  where: str = "input") -> list[str]:
    """P1/P3/P4 on a column list; returns the extra columns (report mode)."""
    extra, missing = column_diff(columns, schema)
    if missing:
        raise SchemaMismatch(f"{where}: declared columns missing: {missing}")
    if mode == "strict" and extra:
        raise SchemaMismatch(f"{where}: unexpected columns: {extra}")
    return extra


def extra_columns(headers: DataFrame, schema: StructType) -> DataFrame:
    """P3 as a DataFrame ``(source, file_name, extra_column)`` from per-file headers."""
    declared = F.array(*[F.lit(n.lower()) for n in schema.names])
    col = F.explode(F.col("header")).alias("extra_column")
    return (headers.select("source", "file_name", col)
            .where(~F.array_contains(declared, F.lower("extra_column"))))


def _resolve(df: DataFrame, name: str) -> str:
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise SchemaMismatch(f"declared column {name!r} not found in {df.columns}")


def conform(df: DataFrame, schema: StructType, *, mode: str = "report",
            on_cast_error: str = "null", keep: list[str] | None = None,
            observation: Observation | None = None, rejects: str | None = None) -> DataFrame:
    """Project text columns to the declared schema in one ``select``.

    * columns come out in declared order with declared names and types;
    * ``keep`` lists bookkeeping columns (``_row``, ``_file`` ...) carried along;
    * ``on_cast_error="fail"`` aborts on the first non-null text that does not
      convert; ``"null"`` keeps NULL and, with ``observation``, counts rejects
      per column as a side metric of whatever action runs next (no extra pass);
    * ``rejects`` names a column for what did not convert: an array of ``(column_name, text)``, NULL for
      rows without any, which is nearly all of them.
    """
    check_columns(df.columns, schema, mode)
    keep = keep or []
    kinds = dict(df.dtypes)
    # Two steps, so that a value is computed once however often it is looked at:
    # parse (dates without their range check), then range check and reject flags.
    parsed: list[Column] = []
    out: list[Column] = []
    flags: list[str] = []
    for field in schema.fields:
        name = _resolve(df, field.name)
        src = df[name]
        is_text = kinds[name] == "string"
        typed = field.dataType.simpleString() != "string"
        is_date = is_text and isinstance(field.dataType, DateType)
        first = any_date(src) if is_date else \
            cast_text(src, field.dataType) if is_text else src.cast(field.dataType)
        parsed.append(first.alias(field.name))
        value = in_range(field.name) if is_date else F.col(field.name)
        if is_text and typed:
            text = f"_text_{field.name}"
            parsed.append(src.alias(text))
            if on_cast_error == "fail":
                value = F.when(is_reject(text, value),
                               F.raise_error(F.concat(F.lit(f"cannot convert {field.name}: '"),
                                                      F.col(text), F.lit("'"))).cast(field.dataType)
                               ).otherwise(value)
            if observation is not None or rejects:
                flag = f"_reject_{field.name}"
                out.append(is_reject(text, value).alias(flag))
                flags.append(flag)
        out.append(value.alias(field.name))
    texts = [F.col(f"_text_{f[len('_reject_'):]}").alias(f"_text_{f[len('_reject_'):]}") for f in flags] if rejects else []
    result = df.select(*parsed, *[df[k] for k in keep]).select(*out, *texts, *keep)
    kept = []
    if rejects:
        kept = [rejects]
        result = result.withColumn(rejects, _rejected(flags))
    order = [*schema.names, *flags, *kept, *keep]
    result = result.select(*order)
    if observation is not None:
        metrics = [F.count_if(F.col(f)).alias(f"rejects{f[len('_reject'):]}") for f in flags]
        result = result.observe(observation, F.count(F.lit(1)).alias("rows"),
                                *(metrics or [F.lit(0).alias("rejects")]))
    return result.drop(*flags)


def _rejected(flags: list[str]) -> Column:
    """The columns of a row that did not convert, with their texts."""
    if not flags:
        return F.lit(None).cast("array<struct<column_name:string,text:string>>")
    names = [f[len("_reject_"):] for f in flags]
    each = F.array(*[F.when(F.col(f), F.struct(F.lit(n).alias("column_name"), F.col(f"_text_{n}").alias("text")))
                     for f, n in zip(flags, names, strict=True)])
    any_flag = reduce(lambda a, b: a | b, [F.col(f) for f in flags])
    return F.when(any_flag, F.filter(each, lambda x: x.isNotNull()))


def conform_to_target(df: DataFrame, target: StructType) -> DataFrame:
    """Match a typed frame to a target table's schema by name.

    ``DataFrame.to`` reorders by name and applies only safe or ANSI-checked casts:
    a BIGINT key fits an INT column unless it overflows, which fails.
    """
    relaxed = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in target.fields])
    out = df.to(relaxed)
    required = [f.name for f in target.fields if not f.nullable]
    if not required:
        return out
    checked = {
        name: F.when(F.col(name).isNull(),
                     F.raise_error(F.lit(f"NULL in NOT NULL column {name}"))
                     .cast(target[name].dataType)).otherwise(F.col(name))
        for name in required
    }
    return out.withColumns(checked)


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """P10."""
    return df.toDF(*names)
