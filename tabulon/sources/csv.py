"""Quote-aware CSV reading and writing.

Files are read as text (no inference): every column is a string and conversion
to declared types happens later in one projection.  Fields may hold doubled
quotes, commas and line breaks, so records may span lines (``multiLine``); such
a file cannot be split, which makes one file one partition and lets
``monotonically_increasing_id`` taken right on the scan record row order within
each file.

Reading many files whose headers differ with one reader would map columns by
position under the first file's header, silently.  ``read_csv_sources`` groups
files by their actual header and runs one reader per distinct header, then
unions by name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tabulon.functions.inference import inferred_types, with_types
from tabulon.session import stage
from tabulon.sources.files import file_headers, file_inventory

# --- fixed values: the quote-aware reader options --------------------------------
CSV_READ_OPTIONS = {
    "header": "true",
    "inferSchema": "false",
    "quote": '"',
    "escape": '"',
    "escapeQuotes": "true",
    "multiLine": "true",
}
# Writer options producing files the reader above round-trips exactly.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "escapeQuotes": "true",
}
# ---------------------------------------------------------------------------------

ROW = "_row"        # row order within its split (monotonic, from the scan)
BLOCK = "_block"    # byte offset of the split within its file (0 for multi-line files)
SEQ = "_seq"        # file order: rank of the file name below the root
FILE = "_file"      # file name relative to the inventory root
SOURCE = "_source"  # first path component: one yearly extract
CORRUPT = "_corrupt_record"  # text of a record with more or fewer fields than its header, else NULL

# Above this many files the file table is joined without a broadcast.
BROADCAST_MAX_FILES = 100_000


@dataclass
class FileSet:
    """The files of one read, with their headers: metadata only, never data.

    ``files`` holds one dict per file (``path``, ``path_key``, ``file_name``,
    ``source``, ``header``, ``seq``); ``seq`` ranks file names, which is the
    processing order.
    """

    root: str
    files: list[dict]

    def groups(self) -> list[tuple[list[str], list[str]]]:
        """Distinct headers with their files; the earliest file's group first."""
        by_header: dict[tuple, list[str]] = {}
        for f in self.files:
            by_header.setdefault(tuple(f["header"]), []).append(f["path"])
        return [(list(h), paths) for h, paths in by_header.items()]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(f["path_key"], f["seq"], f["file_name"], f["source"]) for f in self.files]
        return spark.createDataFrame(rows, f"path_key string, {SEQ} int, {FILE} string, {SOURCE} string")

    def listing(self, spark: SparkSession) -> DataFrame:
        """``(file_name, size, modified)`` of exactly the files this set read."""
        rows = [(f["file_name"], f["size"], f["modified"]) for f in self.files]
        return spark.createDataFrame(rows, "file_name string, size long, modified timestamp")

    def headers(self, spark: SparkSession) -> DataFrame:
        rows = [(f["path"], f["source"], f["file_name"], list(f["header"])) for f in self.files]
        return spark.createDataFrame(rows, "path string, source string, file_name string, header array<string>")


def scan_files(inventory: DataFrame, root: str) -> FileSet:
    """Sniff every file's header (inside tasks) and collect the file metadata.

    The driver receives each distinct header once (keyed by a hash of its
    names) and one short record per file; no task ever gathers a whole group.
    """
    heads = (file_headers(inventory.select("path", "path_key", "file_name", "source", "size", "modified"))
             .withColumn("hid", F.sha2(F.to_json(F.col("header")), 256))
             .cache())  # one row per file, read by the two actions below
    try:
        headers = {r["hid"]: list(r["header"]) for r in
                   heads.groupBy("hid").agg(F.first("header").alias("header")).collect()}
        rows = heads.select("path", "path_key", "file_name", "source", "size", "modified", "hid").collect()
    finally:
        heads.unpersist()
    files = sorted(({**r.asDict(), "header": headers[r["hid"]]} for r in rows),
                   key=lambda f: f["file_name"])
    for seq, f in enumerate(files):
        f["seq"] = seq
    return FileSet(root, files)


def read_csv_text(spark: SparkSession, paths: str | list[str], schema: StructType | None = None,
                  **options: str) -> DataFrame:
    """Header, all strings, quote-aware, multi-line records."""
    reader = spark.read.options(**{**CSV_READ_OPTIONS, **options})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


def read_csv_inferred(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv", **options: str) -> DataFrame:
    """All files below ``paths`` with inferred types, columns matched by name whatever each file's header.

    The text is parsed once and stored; types come from one aggregate over all rows of all files
    (``functions.inference``), so a column is widened by whatever file holds the odd value.  A column that
    some files lack is NULL there.
    """
    roots = [paths] if isinstance(paths, str) else list(paths)
    text = None
    for root in roots:
        part = read_csv_sources(spark, scan_files(file_inventory(spark, root, pattern), root), **options)
        part = part.drop(SEQ, BLOCK, ROW, FILE, SOURCE, CORRUPT)
        text = part if text is None else text.unionByName(part, allowMissingColumns=True)
    text = stage(text, "csv-text")
    return with_types(text, inferred_types(text))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists",
              partition_by: list[str] | None = None, **options: str) -> None:
    writer = df.write.mode(mode).options(**{**CSV_WRITE_OPTIONS, **options})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def header_groups(inventory: DataFrame, root: str = "") -> tuple[DataFrame, list[tuple[list[str], list[str]]]]:
    """Per-file headers as a DataFrame, and the distinct headers with their files."""
    fs = scan_files(inventory, root)
    return fs.headers(inventory.sparkSession), fs.groups()


def read_csv_sources(spark: SparkSession, files: FileSet, **options: str) -> DataFrame:
    """One text reader per distinct header, unioned by name, with file order.

    Adds ``_seq`` (file order), ``_block`` (split offset) and ``_row`` (taken
    on the scan, increasing within a split): ``(_seq, _block, _row)`` is the
    row order of the input.  With ``multiLine`` (the default) a file is one
    split; with ``multiLine="false"`` large single-line files are read in
    parallel splits and the order still holds.  Also adds ``_file``, ``_source`` and
    ``_corrupt_record`` (set where a record has surplus or missing fields).  Rows are matched to their
    file by ``_metadata.file_path`` against the file table, which is broadcast
    when its size (the number of files, known here) allows.
    """
    frames = []
    for header, paths in files.groups():
        if len(set(h.lower() for h in header)) != len(header):
            raise ValueError(f"duplicate column names in header {header} of {paths[:3]}")
        schema = StructType([StructField(h, StringType(), True) for h in [*header, CORRUPT]])
        scan = read_csv_text(spark, paths, schema, columnNameOfCorruptRecord=CORRUPT, **options)
        frames.append(scan.select("*", F.monotonically_increasing_id().alias(ROW),
                                  F.col("_metadata.file_block_start").alias(BLOCK),
                                  F.col("_metadata.file_path").alias("_path_key")))
    return with_files(spark, files, frames)


def with_files(spark: SparkSession, files: FileSet, frames: list[DataFrame]) -> DataFrame:
    """The reads of all headers as one, each row with its file's ``_seq``, ``_file`` and ``_source``."""
    if not frames:
        raise FileNotFoundError(f"no files to read below {files.root}")
    out = frames[0]
    for extra in frames[1:]:
        out = out.unionByName(extra, allowMissingColumns=True)
    lookup = files.table(spark)
    if len(files.files) <= BROADCAST_MAX_FILES:
        lookup = F.broadcast(lookup)
    joined = out.join(lookup, out["_path_key"] == lookup["path_key"], "left")
    checked = F.when(F.col(SEQ).isNull(),
                     F.raise_error(F.concat(F.lit("row from unlisted file "), F.col("_path_key")))
                     .cast("int")).otherwise(F.col(SEQ))
    return joined.withColumn(SEQ, checked).drop("_path_key", "path_key")


def row_positions(df: DataFrame, out: str = "row_pos") -> DataFrame:
    """1-based position of each row within its source (files in name order).

    ``df`` is read twice, so stage it first if it is costly.  Uses one small per-split table (first row id, row count, offset of earlier
    splits and files of the same source) joined back to the rows: no window
    over the data itself, so a huge source never has to fit one task.
    """
    from pyspark.sql import Window

    per_split = df.groupBy(SOURCE, SEQ, BLOCK).agg(F.min(ROW).alias("_first"),
                                                   F.count(F.lit(1)).alias("_n"))
    earlier = (Window.partitionBy(SOURCE).orderBy(SEQ, BLOCK)
               .rowsBetween(Window.unboundedPreceding, -1))
    per_split = per_split.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    per_split = stage(per_split.select(SOURCE, SEQ, BLOCK, "_first", "_offset"), "splits")
    if per_split.count() <= BROADCAST_MAX_FILES:  # one row per split: the rows themselves stay where they are
        per_split = F.broadcast(per_split)
    joined = df.join(per_split, [SOURCE, SEQ, BLOCK])
    return (joined.withColumn(out, (F.col(ROW) - F.col("_first") + F.col("_offset") + 1).cast("bigint"))
            .drop("_first", "_offset"))
