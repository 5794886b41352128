"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.session import ship_package

#: ASCII white space of the contracts, as a Java / RE2 character class.
ASCII_SPACE = r"[\x20\x09-\x0D]"
#: Rows handed on per Arrow batch; long texts are further cut by ``BATCH_CHARS``.
BATCH_ROWS = 512
BATCH_CHARS = 4_000_000
#: Keys (8 bytes each) that are broadcast, at most.
BROADCAST_KEYS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def columns(names: Iterable[str]) -> list[Column]:
    """Columns by their exact names, dots and all."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not use (any case), for helper columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def file_bytes(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file, read once on the driver; its size is fixed by the file, not by the data."""
    ship_package(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is not in ``dropped`` (stored, one column of longs).

    Up to ``BROADCAST_KEYS`` keys, counted first, go to the rows; beyond that both are shuffled.
    """
    if dropped.count() <= BROADCAST_KEYS:
        return rows.join(F.broadcast(dropped), key, "left_anti")
    return rows.join(dropped.hint("merge"), key, "left_anti")


def release_memory() -> None:
    """Hands what a Python worker has freed back to the machine.

    A worker lives on after its task, and Arrow and the C library keep freed memory for it; other
    tasks and stages of the executor would go without.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch, each of few rows and few characters (at least one row)."""
    lo = chars = 0
    for i, text in enumerate(texts):
        if i > lo and (i - lo >= BATCH_ROWS or chars + len(text) > BATCH_CHARS):
            yield lo, i
            lo, chars = i, 0
        chars += len(text)
    if lo < len(texts):
        yield lo, len(texts)


def map_texts(df: DataFrame, keep: list[str], text_col: str, make: Callable[[], Callable[[list[str]], list]],
              schema: str) -> DataFrame:
    """The columns ``keep`` of every row and what ``make()`` makes of its text (null: empty).

    ``make`` runs once per task and returns a function from a list of texts to
    a list of Arrow arrays, one per field of ``schema``.  At the end of a task the function's ``close()``
    is called, if it has one, and freed memory is handed back.
    """
    ship_package(df.sparkSession)
    kept = df.select(*columns(keep))
    out = T.StructType([*kept.schema.fields, *T.StructType.fromDDL(schema).fields])
    # plain names on the way in, whatever the columns are called
    picked = df.select(*(c.alias(f"k{i}") for i, c in enumerate(columns(keep))), F.col(text_col).alias("t"))
    names = out.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            kept = batch.columns[:-1]
            texts = [x or "" for x in batch.columns[-1].to_pylist()]
            for lo, hi in small_batches(texts):
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in kept), *work(texts[lo:hi])], names=names)
            del batch, kept, texts
        getattr(work, "close", lambda: None)()
        release_memory()

    return picked.mapInArrow(run, out)
