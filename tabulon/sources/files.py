"""File inventories and per-file metadata.

The inventory is a DataFrame built from Spark's own listing (``binaryFile`` with
only ``path`` and ``length`` selected, so file contents are never read).  Hidden
files (``.name``, ``_name``) are skipped by Spark's listing.

Per-file work that needs the bytes of a file (its header record, archive
members) runs inside tasks through ``pyarrow.fs``, which reaches the same shared
storage as Spark (local, HDFS, S3, GCS), so nothing passes through the driver.
"""

from __future__ import annotations

import csv
import io
import re
import urllib.parse
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def store_uri(uri: str) -> str:
    """The name Arrow knows a store by, from Hadoop's (``s3a`` and ``s3n`` are both S3)."""
    return re.sub(r"^s3[an]://", "s3://", uri)


def fs_for(uri: str):
    """``(filesystem, path)`` for a Spark-style URI, usable inside tasks."""
    from pyarrow import fs as pafs

    if uri.startswith("file:"):
        path = re.sub(r"^file:/*", "/", uri)
        return pafs.LocalFileSystem(), path
    if "://" not in uri:
        if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", uri):
            raise ValueError(f"tasks cannot open {uri}: no file system for its scheme")
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(store_uri(uri))


class atomic_output:
    """Context manager: a writable stream to ``uri`` that appears under its final
    name only when closed without error (temporary name, then move)."""

    def __init__(self, uri: str):
        import uuid

        self.fs, self.path = fs_for(uri)
        parent = self.path.rsplit("/", 1)[0]
        self.fs.create_dir(parent, recursive=True)
        self.tmp = f"{parent}/.tmp-{uuid.uuid4().hex}"

    def __enter__(self):
        self.stream = self.fs.open_output_stream(self.tmp)
        return self.stream

    def __exit__(self, kind, value, tb):
        self.stream.close()
        if kind is None:
            self.fs.move(self.tmp, self.path)
        else:
            self.fs.delete_file(self.tmp)
        return False


def write_file_atomic(uri: str, chunks) -> int:
    """Write ``chunks`` (iterable of bytes) to ``uri`` via a temporary name.

    A retried or speculative task attempt rewrites the same final name, so the
    result is idempotent; readers never see a half-written file.
    """
    import uuid

    fs, path = fs_for(uri)
    parent = path.rsplit("/", 1)[0]
    fs.create_dir(parent, recursive=True)
    tmp = f"{parent}/.tmp-{uuid.uuid4().hex}"
    n = 0
    with fs.open_output_stream(tmp) as out:
        for chunk in chunks:
            out.write(chunk)
            n += len(chunk)
    fs.move(tmp, path)
    return n


def _root_path(root: str) -> str:
    return re.sub(r"^file:/*", "/", root).rstrip("/")


def file_listing(spark: SparkSession, root: str, pattern: str = "*.csv",
                 modified_after: datetime | None = None) -> DataFrame:
    """Spark's own recursive listing: ``path, length, modificationTime`` only.

    ``modified_after`` (with a time zone; whole seconds) leaves out files that are not younger while Spark lists, so
    they are in no plan and no task.
    """
    reader = (spark.read.format("binaryFile")
              .option("pathGlobFilter", pattern)
              .option("recursiveFileLookup", "true"))
    if modified_after is not None:
        reader = (reader.option("timeZone", "UTC")
                  .option("modifiedAfter", modified_after.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")))
    return (reader.load(root)
            .select("path", "length", "modificationTime",
                    F.col("_metadata.file_path").alias("path_key")))


def inventory_from_listing(listing: DataFrame, root: str) -> DataFrame:
    """Inventory columns for a ``binaryFile``-style listing (batch or micro-batch).

    ``path`` is the plain path (for opening the file); ``path_key`` is Spark's
    URL-encoded form, equal to ``_metadata.file_path`` of any scan of the file,
    and is what rows are matched to their file by.
    """
    prefix = _root_path(root)
    rel = F.regexp_replace(F.col("path"), r"^.*?\Q" + prefix + r"\E/", "")
    return listing.select(F.substring_index(rel, "/", 1).alias("source"),
                          rel.alias("file_name"),
                          "path",
                          F.col("length").alias("size"),
                          F.col("modificationTime").alias("modified"),
                          "path_key")


def file_inventory(spark: SparkSession, root: str, pattern: str = "*.csv",
                   modified_after: datetime | None = None) -> DataFrame:
    """All files below ``root`` matching ``pattern`` (younger than ``modified_after``, if given).

    Columns: ``source`` (first path component below the root: a yearly file, or
    a folder of part files forming one yearly extract), ``file_name`` (path
    relative to the root; its string order is the processing order), ``path``,
    ``size``, ``modified``, ``path_key``.
    """
    return inventory_from_listing(file_listing(spark, root, pattern, modified_after), root)


def empty_files(spark: SparkSession, root: str, pattern: str = "*.csv", listed: set[str] | None = None) -> list[str]:
    """Names below ``root`` of files without bytes, which Spark's scans leave out.

    Spark's file index knows them; its names are compared with ``listed``, the names of the files that a read of ``root`` found
    (listed anew where the caller has none).
    """
    index = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(root))
    names = {re.sub(r"^.*?" + re.escape(_root_path(root)) + "/", "", urllib.parse.unquote(p)) for p in index.inputFiles()}
    if listed is None:
        listed = {r["file_name"] for r in file_inventory(spark, root, pattern).select("file_name").collect()}
    return sorted(names - listed)


def with_row_identity(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """A Parquet read with the file and the place in it of each row, and the names of these two columns.

    They identify a row on every read, so nothing has to be numbered and written out first.
    """
    names = ["_row_file", "_row_index"]
    return df.select("*", F.col("_metadata.file_path").alias(names[0]), F.col("_metadata.row_index").alias(names[1])), names


def _first_record(uri: str, sep: str, quote: str) -> list[str]:
    fs, path = fs_for(uri)
    with fs.open_input_stream(path) as raw:
        text = io.TextIOWrapper(io.BufferedReader(raw), encoding="utf-8", newline="")
        reader = csv.reader(text, delimiter=sep, quotechar=quote, doublequote=True)
        try:
            record = next(reader)
        except StopIteration:
            return []
    if record and record[0].startswith("﻿"):
        record[0] = record[0][1:]
    return record


def file_headers(inventory: DataFrame, sep: str = ",", quote: str = '"') -> DataFrame:
    """``inventory`` with the ``header`` of every file, read inside tasks.

    Only the first record of each file is read, so the cost is one small read
    per file regardless of file size; the other columns pass through, so nothing is joined.
    """

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(header=[_first_record(p, sep, quote) for p in pdf["path"]])

    spread = spread_files(inventory)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spread.schema.fields)
    return spread.mapInPandas(heads, f"{fields}, header array<string>")


def spread_files(listing: DataFrame) -> DataFrame:
    """Spread a file listing over the cluster's task slots.

    A listing is tiny, so Spark packs it into one partition; per-file work
    (reading a header, unpacking an archive) must instead run in parallel.  With a
    ``size`` column the files are dealt out in order of size, so each slot
    gets its share of the large ones; else by hash of the path.
    """
    from tabulon.session import ship_package

    ship_package(listing.sparkSession)
    slots = listing.sparkSession.sparkContext.defaultParallelism
    if "size" not in listing.columns:
        return listing.repartition(max(1, slots), "path")
    turn = F.row_number().over(Window.orderBy(F.desc("size"), "path")) % slots  # metadata: one row per file
    return listing.withColumn("_turn", turn).repartitionByRange(max(1, slots), "_turn").drop("_turn")
