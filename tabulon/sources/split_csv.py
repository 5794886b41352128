"""Reading one multi-line CSV file in many tasks (S1 at scale).

Spark reads a CSV file whose quoted fields hold line breaks in one task, whatever its
size, because a line break alone does not tell where a record ends.  It does once the quotes
before it are known: outside of quotes their number is even.  So:

1. lines come from Spark's splittable text source, and each split counts its quotes
   (an aggregate; a row per split);
2. a prefix sum over a file's splits tells each split whether it begins inside a quoted field;
3. each split joins its lines to records, carrying the parity from line to line (array
   operations on Arrow batches, nothing is shuffled);
4. what a split holds of a record that began earlier is joined with the piece before it: a
   few rows per split, the only rows that are shuffled;
5. Spark's own ``from_csv`` parses the records with the reader's options.

The result is that of ``read_csv_sources``.  Row order is ``(_seq, _block, _row)`` as there, with the split where a
record begins and its number there.

Bounds: a task holds a batch and the record it is in; a record of many splits is put together by one
task, like any cell of a table.  Quotes must be as RFC 4180 wants them (a field with a quote is quoted, its quotes are
doubled; Spark's writer does so).  A file whose quotes do not pair is reported by ``unpaired_quotes`` and makes
the read fail, as from its first stray quote on records would be cut in the wrong places.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.session import ship_package, stage
from tabulon.sources.csv import BLOCK, BROADCAST_MAX_FILES, CORRUPT, CSV_READ_OPTIONS, ROW, FileSet, with_files

_BREAK = "\n"
_RECORDS = "path_key string, block bigint, record_no bigint, kind string, record string"
# kinds of rows: a whole record, the begin of one that a later split ends, a piece without the record's begin
_WHOLE, _BEGIN, _MIDDLE, _END = "whole", "begin", "middle", "end"


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their split; only ``\\n`` ends a line here, as the parser itself knows ``\\r\\n``."""
    return spark.read.option("lineSep", _BREAK).text(paths).select(
        F.col("_metadata.file_path").alias("path_key"), F.col("_metadata.file_block_start").alias("block"), "value")


def _parities(lines: DataFrame, quote: str) -> DataFrame:
    """Per split: whether it begins inside a quoted field, and the file's number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    splits = lines.groupBy("path_key", "block").agg(F.sum(quotes.cast("long")).alias("quotes"))
    before = Window.partitionBy("path_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path_key")
    return stage(splits.select(
        "path_key", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"),
        F.sum("quotes").over(whole).alias("file_quotes")), "csv-splits")


def unpaired_quotes(spark: SparkSession, paths: list[str], quote: str = '"') -> DataFrame:
    """``path_key`` of files with an odd number of quotes, which cannot be cut into records."""
    return _parities(_lines(spark, paths), quote).where("file_quotes % 2 = 1").select("path_key").distinct()


class _Split:
    """Records of one split, from its lines in order; those that begin here are numbered, blank ones left out."""

    def __init__(self, path_key: str, block: int, inside: bool, quote: str) -> None:
        self.path_key, self.block, self.quote = path_key, block, quote
        self.odd = inside           # quotes so far are odd: the next line continues a record
        self.headless = inside      # the open record began in an earlier split
        self.held: list[str] = []   # lines of the open record
        self.record = 0             # number of the next record

    def _rows(self, kind: str, records: pa.Array) -> pa.RecordBatch:
        if kind == _WHOLE:
            records = records.filter(pc.invert(pc.is_in(records, pa.array(["", "\r"]))))
        n = len(records)
        numbers = pa.array(np.arange(self.record, self.record + n), pa.int64())
        self.record += n if kind in (_WHOLE, _BEGIN) else 0
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(self.path_key, pa.string()), n), pa.repeat(pa.scalar(self.block, pa.int64()), n), numbers,
             pa.repeat(pa.scalar(kind, pa.string()), n), records], names=["path_key", "block", "record_no", "kind", "record"])

    def _open(self, kind: str) -> pa.RecordBatch:
        return self._rows(kind, pa.array([_BREAK.join(self.held)], pa.string()))

    def add(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        odd = (np.cumsum(pc.count_substring(values, self.quote).to_numpy(zero_copy_only=False)) + self.odd) % 2 == 1
        ends = np.flatnonzero(~odd)  # lines that end a record
        self.odd = bool(odd[-1])
        if not len(ends):
            self.held += values.to_pylist()
            return
        start = 0
        if self.held or self.headless:  # the record that was open ends here
            start, ends = int(ends[0]) + 1, ends[1:]
            self.held += values[:start].to_pylist()
            yield self._open(_END if self.headless else _WHOLE)
            self.headless = False
        if len(ends):
            offsets = pa.array(np.r_[start, ends + 1].astype(np.int32))
            yield self._rows(_WHOLE, pc.binary_join(pa.ListArray.from_arrays(offsets, values.cast(pa.string())), _BREAK))
            start = int(ends[-1]) + 1
        self.held = values[start:].to_pylist()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held or self.headless:
            yield self._open(_MIDDLE if self.headless else _BEGIN)


def _cut(quote: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split: _Split | None = None
        for batch in batches:
            keys = list(zip(batch["path_key"].to_pylist(), batch["block"].to_pylist(), strict=True))
            at = 0
            while at < len(keys):  # a task may read several splits, one after another
                to = at + 1
                while to < len(keys) and keys[to] == keys[at]:
                    to += 1
                if split is None or (split.path_key, split.block) != keys[at]:
                    if split is not None:
                        yield from split.rest()
                    split = _Split(*keys[at], bool(batch["inside"][at].as_py()), quote)
                yield from split.add(batch["value"].slice(at, to - at))
                at = to
        if split is not None:
            yield from split.rest()
    return run


def split_records(spark: SparkSession, paths: list[str], quote: str = '"') -> DataFrame:
    """``(path_key, block, record_no, record)``: the raw text of every record that is not blank, headers included."""
    ship_package(spark)
    lines = _lines(spark, paths)
    splits = _parities(lines, quote)
    total, unpaired = splits.agg(F.count(F.lit(1)), F.max(F.when(F.col("file_quotes") % 2 == 1, F.col("path_key")))).first()
    if unpaired is not None:
        raise ValueError(f"quotes do not pair in {unpaired}")
    inside = splits.select("path_key", "block", "inside")
    if total <= BROADCAST_MAX_FILES:  # one row per split, counted: the lines stay in their order
        joined = lines.join(F.broadcast(inside), ["path_key", "block"])
    else:
        # a merge join deals lines anew, so their order is taken before and restored within each split
        at = lines.withColumn("at", F.monotonically_increasing_id())
        joined = at.join(inside.hint("merge"), ["path_key", "block"]).sortWithinPartitions("path_key", "block", "at")
    pieces = stage(joined.select("path_key", "block", "inside", "value").mapInArrow(_cut(quote), _RECORDS), "csv-records")

    # every piece of a broken record gets the record's begin: the last begin at or before it in the file (few rows)
    broken = pieces.where(F.col("kind") != _WHOLE)
    order = Window.partitionBy("path_key").orderBy("block", F.col("kind") == _BEGIN)
    begin = F.when(F.col("kind") == _BEGIN, F.struct("block", "record_no"))
    broken = broken.withColumn("begin", F.last(begin, ignorenulls=True).over(order))
    mended = broken.groupBy("path_key", "begin").agg(
        F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts")).select(
        "path_key", F.col("begin.block").alias("block"), F.col("begin.record_no").alias("record_no"),
        F.array_join(F.col("parts.record"), _BREAK).alias("record"))
    return pieces.where(F.col("kind") == _WHOLE).select("path_key", "block", "record_no", "record").unionByName(mended)


def read_csv_split(spark: SparkSession, files: FileSet, **options: str) -> DataFrame:
    """``read_csv_sources`` for files that are too large for a task each: one text column per header name, file order."""
    settings = {**CSV_READ_OPTIONS, **options}
    frames = []
    for header, paths in files.groups():
        if len(set(h.lower() for h in header)) != len(header):
            raise ValueError(f"duplicate column names in header {header} of {paths[:3]}")
        fields = ", ".join(f"`{h.replace('`', '``')}` STRING" for h in [*header, CORRUPT])
        records = split_records(spark, paths, settings["quote"]).where(
            "not (block = 0 and record_no = 0)" if settings["header"] == "true" else "true")
        text = F.regexp_replace("record", "\r(\n|$)", "$1")  # as the reader does
        parsed = F.from_csv(text, fields, {
            **{k: v for k, v in settings.items() if k not in ("header", "inferSchema", "multiLine")},
            "columnNameOfCorruptRecord": CORRUPT})
        frames.append(records.select(
            parsed.alias("fields"), F.col("record_no").alias(ROW), F.col("block").alias(BLOCK), F.col("path_key").alias("_path_key"))
            .select("fields.*", ROW, BLOCK, "_path_key"))
    return with_files(spark, files, frames)
