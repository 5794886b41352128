"""Operator 2: sharding by extendible hashing, in DataFrame functions only.

A row's address is a string of bits: 32 of the MD5 of its id, then 64 of the hash of its
stored row number, so that rows with one id can still be told apart.  The directory is
indexed by leading bits: the root bucket holds everything, and a bucket over the
byte limit splits on one bit more until every shard fits.  Bytes are summed for
all prefixes of a cell of the directory in one aggregation; the shards are the largest buckets
that fit below buckets that do not.  Cells that are still too large when their bits are used up are
refined by further bits in another round.

A row's size is the UTF-8 bytes of its text and ``record_bytes`` (its line end), so that
rows without text fill shards too.  A single row over the limit is a shard of
its own.  Null and empty texts have 0 bytes; a null id hashes as an empty text.  An empty
table gives no rows.  ``write_shards`` writes each shard as one folder.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import fresh
from tabulon.session import stage

ID_BITS = 32
#: Further bits of the cells below the depth that even shards would need, and by which cells are refined.
SPARE_BITS = 3
REFINE_BITS = 8


def _bits():
    own = F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))), 1, ID_BITS // 4)
    return F.concat(F.lpad(F.conv(own, 16, 2), ID_BITS, "0"), F.lpad(F.bin(F.xxhash64("uid")), 64, "0"))


def _directory(rows: DataFrame, depth: int, width: int, limit: int) -> DataFrame:
    """``cell, shard, shard_bytes`` for the cells of ``width`` bits whose rows are in a shard that fits.

    All rows lie in buckets of ``depth`` bits that are too large (or the root).
    """
    cells = stage(rows.groupBy(F.substring("bits", 1, width).alias("cell")).agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "cells")
    nodes = (cells.select(F.explode(F.sequence(F.lit(depth), F.lit(width))).alias("d"), "cell", "bytes", "n")
             .groupBy(F.expr("substring(cell, 1, d)").alias("prefix"), "d")
             .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")))
    nodes = stage(nodes.withColumn("fits", (F.col("bytes") <= limit) | (F.col("n") == 1)), "nodes")
    parents = nodes.filter("not fits").select(F.col("prefix").alias("above"), (F.col("d") + 1).alias("d"))
    fitting = nodes.filter("fits")
    # a root that fits is a shard; lower down, buckets that fit below one that does not
    shards = fitting.join(
        parents, (fitting["d"] == parents["d"]) & (F.expr("left(prefix, length(prefix) - 1)") == parents["above"]),
        "left_semi")
    if depth == 0:
        shards = shards.unionByName(fitting.filter("d = 0"))
    shards = stage(shards.select(F.col("prefix").alias("shard"), "d", F.col("bytes").alias("shard_bytes")), "shards")
    depths = sorted(r["d"] for r in shards.select("d").distinct().collect())  # at most 96 values
    if not depths:
        return cells.select("cell", F.lit("").alias("shard"), F.lit(0).cast("long").alias("shard_bytes")).limit(0)
    pairs = cells.select("cell", F.explode(F.lit(depths)).alias("d")).withColumn(
        "shard", F.expr("substring(cell, 1, d)"))
    return pairs.join(shards, ["shard", "d"]).select("cell", "shard", "shard_bytes")


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """``uid, id, n_bytes, shard, shard_bytes`` of stored ``(uid, id, n_bytes, size, bits)``."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    depth, width = 0, max(1, math.ceil(math.log2(total / limit + 1)) + SPARE_BITS)
    out = None
    while True:
        directory = _directory(rows, depth, width, limit)
        placed = rows.withColumn("cell", F.substring("bits", 1, width))
        done = placed.join(directory, "cell").select("uid", "id", "n_bytes", "shard", "shard_bytes")
        out = done if out is None else out.unionByName(done)
        left = placed.join(directory, "cell", "left_anti").drop("cell")
        if width >= ID_BITS + 64 or left.isEmpty():
            return out
        rows = stage(left, "overfull")
        depth, width = width, min(width + REFINE_BITS, ID_BITS + 64)


def _sized(docs: DataFrame, uid: Column, record_bytes: int, id_col: str, text_col: str) -> DataFrame:
    return stage(docs.select(
        uid.alias("uid"), F.col(id_col).alias("id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
        .withColumn("size", F.col("n_bytes") + record_bytes), "sizes").withColumn("bits", _bits())


def assign_shards(docs: DataFrame, limit: int, record_bytes: int = 1, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id, n_bytes, shard, shard_bytes`` of every row; ``shard`` is the bucket's prefix of bits."""
    rows = _sized(docs, F.monotonically_increasing_id(), record_bytes, id_col, text_col)
    return _placed(rows, limit).drop("uid").withColumnRenamed("id", id_col)


def write_shards(docs: DataFrame, path: str, limit: int, record_bytes: int = 1, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Every row of ``docs``, with all its columns, in the folder ``shard=b<bits>`` of its shard below ``path``.

    Rows are numbered and stored first, and placed by that number: a null id and an id on many rows are
    written as often as they occur.  Returns ``(shard, n_rows, shard_bytes)``.
    """
    uid, shard = fresh(docs, "uid", "shard")
    numbered = stage(docs.withColumn(uid, F.monotonically_increasing_id()), "numbered")
    placed = stage(_placed(_sized(numbered, F.col(uid), record_bytes, id_col, text_col), limit).select(
        F.col("uid").alias(uid), F.concat(F.lit("b"), "shard").alias(shard), "shard_bytes"), "placed")
    (numbered.join(placed.select(uid, shard), uid).drop(uid).repartition(shard)
     .write.partitionBy(shard).parquet(path))
    return placed.groupBy(F.col(shard).alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"),
                                                           F.first("shard_bytes").alias("shard_bytes"))


def oracle_sql(limit: int, record_bytes: int = 1, levels: int = 24) -> str:
    """The same rows in DuckDB, for unique ids and at most ``levels`` bits."""
    prefix = "substr(bits, 1, {0})"
    sums = ", ".join(f"sum(n_bytes + {record_bytes}) OVER (PARTITION BY {prefix.format(d)}) AS s{d}, "
                     f"count(*) OVER (PARTITION BY {prefix.format(d)}) AS c{d}" for d in range(levels + 1))
    case = " ".join(f"WHEN s{d} <= {limit} OR c{d} = 1 THEN {{{d}}}" for d in range(levels + 1))
    shard = case.format(*(prefix.format(d) for d in range(levels + 1)))
    size = case.format(*(f"s{d}" for d in range(levels + 1)))
    return f"""
        WITH sized AS (
            SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
                   lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)),
                        {ID_BITS}, '0') AS bits
            FROM documents),
        summed AS (SELECT doc_id, n_bytes, bits, {sums} FROM sized)
        SELECT doc_id, n_bytes, CASE {shard} END AS shard, CAST(CASE {size} END AS BIGINT) AS shard_bytes
        FROM summed"""
