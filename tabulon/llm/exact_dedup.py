"""Operator 7: exact duplicates through an extendible-hash index, in DataFrame functions only.

Texts are equal when they are identical without ASCII white space.  Every row
gets the address of its normalised text: a 64-bit hash, and within it a chain
key (SHA-256).  The rows of an address are combined map-side to one slot, so a
text copied millions of times is one small row.  A directory indexed by leading
hash bits doubles until no bucket holds more than ``capacity`` slots (or
``max_depth`` bits are used); slots are written to the shared folder by bucket, each
bucket a range of hashes owned by one task.  Rows then look their slot up.

Bytes are compared: the normalised texts of every slot with several rows are read
again and must have equal minimum and maximum.  Slots where they do not are
chained further by the text itself.

Null counts as an empty text; empty and blank texts are equal.  Of equal texts the one with the
most characters stays, then the smallest id (null last); of rows that repeat
with id and length, any one stays.  Repeated rows count in the group's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import ASCII_SPACE, BROADCAST_KEYS, columns, without
from tabulon.session import stage

ADDRESS = ["hash", "chain", "chained_text"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{ASCII_SPACE}+", "")


def _address(text: Column) -> Column:
    return F.xxhash64(text)


def _chain(text: Column) -> Column:
    return F.sha2(text, 256)


def _entries(rows: DataFrame, clashes: DataFrame | None = None) -> DataFrame:
    """``uid, id, n_chars`` and the address of every row of ``rows`` (``uid, id, text``), stored."""
    found = (rows.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))))
             .withColumn("text", normalised(F.col("text")))
             .withColumn("hash", _address(F.col("text"))).withColumn("chain", _chain(F.col("text"))))
    if clashes is None:
        found = found.withColumn("chained_text", F.lit(""))
    else:
        found = (found.join(clashes.withColumn("clash", F.lit(True)), ["hash", "chain"], "left")
                 .withColumn("chained_text", F.when(F.col("clash"), F.col("text")).otherwise("")))
    return stage(found.select("uid", "id", "n_chars", *ADDRESS), "entries")


def _slots(entries: DataFrame) -> DataFrame:
    """One row per address: rows, and the id and uid of the row that stays."""
    order = F.struct((-F.col("n_chars")).alias("c"), F.col("id").isNull().alias("z"), "id", "uid")
    return entries.groupBy(*ADDRESS).agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("first")).select(
        *ADDRESS, "size", F.col("first.id").alias("keep_id"), F.col("first.uid").alias("keep_uid"))


def directory(counts: list[int], capacity: int) -> list[int]:
    """Bucket number by leading hash bits: a bucket splits on one bit more while it is overfull.

    ``counts`` has the slots of each of ``2 ** depth`` cells.
    """
    buckets = [0] * len(counts)
    number = 0
    todo = [(0, len(counts))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo > 1 and sum(counts[lo:hi]) > capacity:
            middle = (lo + hi) // 2
            todo += [(middle, hi), (lo, middle)]
        else:
            buckets[lo:hi] = [number] * (hi - lo)
            number += 1
    return buckets


def _index(slots: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """``slots`` with their bucket, written bucket by bucket in hash order to the shared folder."""
    stored = stage(slots, "slots")
    cell = F.shiftrightunsigned("hash", 64 - max_depth).cast("int")
    counts = [0] * (1 << max_depth)
    for row in stored.groupBy(cell.alias("cell")).count().collect():  # at most 2 ** max_depth rows
        counts[row["cell"]] = row["count"]
    bucket = F.get(F.lit(directory(counts, capacity)), cell)
    owned = stored.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("bucket", "hash")
    return stage(owned, "index")


def _clashes(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Addresses whose rows differ in some byte."""
    several = stage(index.filter("size > 1").select("hash").distinct(), "several")
    texts = rows.select(normalised(F.col("text")).alias("text")).withColumn("hash", _address(F.col("text")))
    if several.count() <= BROADCAST_KEYS:  # else all texts are combined map-side and compared
        texts = texts.join(F.broadcast(several), "hash", "left_semi")
    return (texts.withColumn("chain", _chain(F.col("text")))
            .groupBy("hash", "chain").agg(F.min("text").alias("least"), F.max("text").alias("most"))
            .filter("least <> most").select("hash", "chain"))


def _looked_up(rows: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """Entries of ``rows`` (``uid, id, text``) with their slot of the index."""
    entries = _entries(rows)
    index = _index(_slots(entries), capacity, max_depth)
    clashes = _clashes(rows, index)
    if not clashes.isEmpty():
        entries = _entries(rows, stage(clashes, "clashes"))
        index = _index(_slots(entries), capacity, max_depth)
    return entries.join(index, ADDRESS)


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               capacity: int = 1024, max_depth: int = 12) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"),  # fixed where the entries are stored
                       F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _looked_up(rows, capacity, max_depth).select(
        F.col("id").alias(id_col), "keep_id", F.col("size").alias("group_size"),
        (F.col("uid") == F.col("keep_uid")).alias("kept"), F.col("chain").alias("text_sha256"))


def first_of_equals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    capacity: int = 1024, max_depth: int = 12) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are."""
    stored = stage(docs.select(F.monotonically_increasing_id().alias("uid"),
                               F.struct(*columns(docs.columns)).alias("row")), "rows")
    rows = stored.select("uid", F.col(f"row.{id_col}").alias("id"), F.col(f"row.{text_col}").alias("text"))
    dropped = _looked_up(rows, capacity, max_depth).filter("uid <> keep_uid").select("uid")
    return without(stored, stage(dropped, "dropped"), "uid").select("row.*")
