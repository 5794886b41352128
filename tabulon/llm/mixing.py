"""Mixing sources to target weights by weighted fair queueing (operator 11).

Every document is a packet of its source's queue, with its number of words as
length.  A queue is shuffled by a hash of the id and served up to three times over;
a copy's virtual finish time is the words of its source up to and with it, divided by
the source's target.  All copies are sorted by finish time over the cluster and
taken until the total budget (the words of all documents) is used up, so each
source has taken about its target when the budget ends.

Targets: sources in code point order (null last) weigh 1, 2, 3, 1, ...; a source's
share of the budget stops at ``most_copies`` times its words, and what is over is
shared again by weight among the others until no source is above.

Scale: text is read once, for word counts; everything after moves a few
numbers a row.  Running totals come from range partitions
(``operators.ranking``), so a source with a third of all rows is spread over
tasks; the row id ends every order, so one id on many rows is spread, too.  Of the copies
only those that can be served within the budget are made.  The driver gets two sums per
sharing round.

Edge cases: null and blank texts have size 0 and take nothing; a null source is a source; a null id is an
id; repeated rows are documents of their own (which of two equal rows is taken
twice does not show in the result); an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import text_or_empty
from tabulon.operators.ranking import running_total
from tabulon.session import stage

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """``(source, source_size)`` with ``weight``, ``target`` (words wanted of each source) and ``start`` (words of
    all sources before it).

    ``sources`` is stored and has a row per source.  Each round shares what full sources leave among the
    others by weight; a source that is full stays full, as the level only rises.
    """
    ranked = running_total(sources, [F.col("source").isNull(), "source"], "source_size", "ends", "place")
    turn = (F.col("place") - 1) % len(weights) + 1
    ranked = stage(ranked.select("source", "source_size", (F.col("ends") - F.col("source_size")).alias("start"),
                                 (F.col("source_size") * most_copies).alias("most"),
                                 F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")).alias("weight")),
                   "sources")
    budget = ranked.agg(F.sum("source_size")).first()[0] or 0
    left, weight = budget, None
    while True:
        open_ = F.lit(True) if weight is None else F.col("most").cast("double") * weight > F.col("weight") * float(left)
        rest, shared = ranked.agg(F.sum(F.when(~open_, F.col("most"))), F.sum(F.when(open_, F.col("weight")))).first()
        now = (budget - (rest or 0), shared or 0)
        if now == (left, weight) or not now[1]:
            break
        left, weight = now
    share = F.col("weight") * F.lit(float(left)) / F.lit(float(weight or 1))
    return ranked.select("source", "source_size", "start", "weight", F.least(F.col("most").cast("double"), share).alias("target"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, copies)`` of every row of ``documents``.

    ``taken`` is the words that the mix takes of the document, over all its ``copies``.
    """
    docs = stage(documents.select(
        "doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORDS)).cast("long").alias("size"))
        .withColumn("rid", F.monotonically_increasing_id()), "sizes")
    sources = targets(stage(docs.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes"),
                      weights, most_copies)
    # a queue's order: by hash of the id; the word count and the row id only tell rows of one id apart
    shuffled = docs.withColumn("turn", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    queue = [F.col("source").isNull(), "source", "turn", "doc_id", "size", "rid"]
    served = running_total(shuffled, queue, "size", "served")
    # the running total starts afresh with each source: less what all sources before it hold
    docs = stage(_with_source(served, sources).withColumn("served", F.col("served") - F.col("start")), "queues")

    taken = _taken(docs, most_copies)
    per_row = taken.groupBy("rid").agg(F.count(F.lit(1)).alias("copies"))
    copies = F.coalesce("copies", F.lit(0)).cast("long")
    return docs.join(per_row, "rid", "left").select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """A source's numbers on each of its rows; Spark splits the join where a source is hot."""
    sources = sources.withColumnRenamed("source", "s")
    return rows.join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s")


def _taken(docs: DataFrame, most_copies: int) -> DataFrame:
    """``rid`` once for each copy that the budget reaches, in order of finish time."""
    queues = docs.where("size > 0 and target > 0")
    budget, longest = queues.agg(F.sum("size"), F.max(F.col("size") / F.col("target"))).first()
    # At time 1 each source is short of its target by less than one document, so by time 1 + the longest
    # service of any document all targets are reached: no copy that finishes later can be within the budget.
    horizon = (1.0 + (longest or 0.0)) * (1 + 1e-9)
    copy = F.explode(F.sequence(F.lit(0), F.lit(most_copies - 1)))
    finish = ((F.col("copy") * F.col("source_size") + F.col("served")).cast("double") / F.col("target"))
    copies = (queues.withColumn("copy", copy).withColumn("finish", finish).where(F.col("finish") <= horizon)
              .select("finish", "source", "turn", "doc_id", "size", "rid", "copy"))
    order = ["finish", F.col("source").isNull(), "source", "copy", "turn", "doc_id", "size", "rid"]
    return running_total(copies, order, "size", "used").where(F.col("used") <= (budget or 0)).select("rid")


def oracle_sql(weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> str:
    """The same mix as ``op11`` returns it, for tables whose ids are unique."""
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return rf"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS size
            FROM documents),
        sources AS (
            SELECT source, source_size, {most_copies} * source_size AS most,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {weight} END AS weight
            FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source)),
        rounds(k, remains, shared) AS (
            SELECT 0, CAST(sum(source_size) AS DOUBLE), CAST(sum(weight) AS DOUBLE) FROM sources
            UNION ALL
            SELECT k + 1, CAST(b - capped AS DOUBLE), CAST(open_weight AS DOUBLE)
            FROM (SELECT k, any_value(r.remains) AS remains, any_value(r.shared) AS shared, sum(source_size) AS b,
                         coalesce(sum(CASE WHEN most * r.shared <= weight * r.remains THEN most END), 0) AS capped,
                         coalesce(sum(CASE WHEN most * r.shared > weight * r.remains THEN weight END), 0) AS open_weight
                  FROM rounds r, sources GROUP BY k)
            WHERE open_weight > 0 AND (b - capped <> remains OR open_weight <> shared)),
        level AS (SELECT remains, shared FROM rounds ORDER BY k DESC LIMIT 1),
        aims AS (SELECT source, source_size, least(CAST(most AS DOUBLE), weight * remains / shared) AS target
                 FROM sources, level),
        queues AS (
            SELECT d.*, source_size, target, sum(size) OVER (
                       PARTITION BY d.source ORDER BY turn, doc_id, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS served
            FROM docs d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source),
        copies AS (
            SELECT doc_id, size, sum(size) OVER (
                       ORDER BY CAST(copy * source_size + served AS DOUBLE) / target, source NULLS LAST, copy, turn, doc_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
            FROM queues, range({most_copies}) AS c(copy) WHERE size > 0 AND target > 0),
        takes AS (SELECT doc_id, count(*) AS copies FROM copies
                  WHERE used <= (SELECT sum(size) FROM docs) GROUP BY doc_id)
        SELECT q.doc_id, q.source, q.size, q.source_size, q.target,
               CAST(q.size * coalesce(t.copies, 0) AS BIGINT) AS taken, coalesce(t.copies, 0) AS copies
        FROM queues q LEFT JOIN takes t ON q.doc_id IS NOT DISTINCT FROM t.doc_id"""
