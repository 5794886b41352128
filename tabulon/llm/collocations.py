"""Phrase collocations by multikey quicksort of suffix pointers (operator 13).

A suffix is a word and the words after it, within its piece of text, to the maximum
depth.  Phrase counts are sizes of equal partitions when suffixes are sorted word by
word: a three-way quicksort by the word at depth d splits a partition into smaller, equal and greater; the equal part
is one phrase of d + 1 words, its size the phrase's count, and goes on at depth d + 1.

* Each task cuts its texts into words, numbers them, and hands on suffixes by number with a local count
  and the words they stand for, packed into one row per language and bucket.  Suffixes of one word (for the words' own
  counts) are dealt by that word, others by their two leading words, so that a frequent leading word is
  spread over buckets and everything that a bucket's partitions count is in that bucket.
* The owner of a bucket sorts its suffix pointers and abandons every partition of fewer than ``least`` occurrences
  before going deeper.  All partitions of a depth are split at once, with array operations.
* The phrases left over are joined with the counts of their parts, scored, filtered and ranked as DataFrames.

Scale: a bucket is about ``BUCKET_WORDS`` words, their number follows from the count of words (one
pass over the text's length); owners hold one bucket at a time.  Equal suffixes of a task are combined before the
shuffle, so copied texts and frequent phrases weigh once per task and batch.  A batch is at most ``BATCH_BYTES`` of text,
held as numbers and a dictionary, and its buckets are packed one at a time;
longer texts are cut between words, with the following words carried along.  Parts of phrases are joined by
phrase, which is unique on the counts' side; Spark splits such a join where a part is hot.

Edge cases: null and blank texts have no words; a null language is ``und``, together with texts of that language;
ids, repeated rows and further columns do not matter (copies count); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.llm.common import release_memory, text_or_empty
from tabulon.session import ship_package, stage

#: Bytes that end a piece, as in the contract: ``. , ; : ! ?`` and line ends.
PIECE_ENDS = b".,;:!?\n\v\f\r"
BATCH_BYTES = 8 << 20
BUCKET_WORDS = 1 << 20
#: Bytes of packed rows handed on at a time.
SENT_BYTES = 1 << 20

_TABLE = bytearray(range(256))
for _c in PIECE_ENDS:
    _TABLE[_c] = 10
_TABLE[9] = 32
for _c in range(65, 91):
    _TABLE[_c] = _c + 32
_TABLE = bytes(_TABLE)
END = b"\n"

PACKED = "lang string, bucket int, words array<binary>, sizes binary, suffixes binary"
COUNTED = "lang string, size int, phrase string, occurrences bigint"


def _slices(text: bytes, depth: int, batch_bytes: int = BATCH_BYTES) -> Iterator[tuple[list[bytes], int]]:
    """Words and piece ends of a text, a batch's bytes at a time, with the number of words at the end that only follow."""
    at = 0
    while at < len(text):
        cut = min(len(text), at + batch_bytes)
        if cut < len(text):
            found = max(text.rfind(b" ", at, cut), text.rfind(END, at, cut))
            if found <= at:  # one word longer than a batch stays whole
                found = min((x for x in (text.find(b" ", cut), text.find(END, cut)) if x >= 0), default=len(text))
            cut = found
        words = _words(text[at:cut])
        more = _following(text, cut, depth - 1)
        yield words + more, len(more)
        at = cut


def _words(text: bytes) -> list[bytes]:
    return [w for w in text.replace(END, b" \n ").split(b" ") if w]


def _following(text: bytes, at: int, n: int) -> list[bytes]:
    """The next ``n`` words or piece ends from a position on, a few at a time."""
    more, span = [], 256
    while at < len(text):
        more = _words(text[at:at + span])
        if len(more) > n or at + span >= len(text):
            break
        span *= 4
    return more[:n]


class _Numbers(dict):
    """Numbers of words in the order they come; the end of a piece is -1."""

    def __init__(self) -> None:
        super().__init__({END: -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 1
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def dictionary(self) -> np.ndarray:
        out = np.empty(len(self) - 1, dtype=object)
        out[:] = list(self)[1:]
        return out


def _windows(words: list[bytes], follow: int, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Dictionary of some words, their suffixes as rows of numbers (-1: the piece has ended), and the words counted."""
    numbers = _Numbers()
    suffixes = _suffixes(numbers.of(words), follow, depth)
    return numbers.dictionary(), suffixes, len(suffixes)


def _suffixes(ids: np.ndarray, follow: int, depth: int) -> np.ndarray:
    padded = np.concatenate([ids, np.full(depth - 1, -1, np.int32)])
    n = len(ids) - follow
    out = np.empty((n, depth), np.int32)
    gone = np.zeros(n, bool)
    for d in range(depth):
        column = padded[d:d + n]
        gone |= column < 0
        out[:, d] = np.where(gone, -1, column)
    return out[out[:, 0] >= 0]


def _combined(suffixes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes and how often each occurs."""
    if not len(suffixes):
        return suffixes, np.zeros(0, np.int64)
    base = int(suffixes.max()) + 2
    if weights is None and base ** suffixes.shape[1] < 1 << 63:  # one number for each suffix sorts faster, and in place
        key = np.zeros(len(suffixes), np.int64)
        for d in range(suffixes.shape[1]):
            key = key * base + (suffixes[:, d] + 1)
        key.sort()
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        counts, key = np.diff(np.r_[starts, len(key)]), key[starts]
        out = np.empty((len(key), suffixes.shape[1]), np.int32)
        for d in reversed(range(suffixes.shape[1])):
            key, out[:, d] = np.divmod(key, base)
        out -= 1
        return out, counts
    order = np.lexsort(suffixes.T[::-1]) if suffixes.shape[1] > 1 else np.argsort(suffixes[:, 0], kind="stable")
    ordered = suffixes[order]
    starts = np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)])
    if weights is None:
        return ordered[starts], np.diff(np.r_[starts, len(ordered)])
    return ordered[starts], np.add.reduceat(weights[order], starts)


def _hashes(dictionary: np.ndarray) -> np.ndarray:
    """64 bits for each word, the same on every machine."""
    return pd.util.hash_array(np.array([w.decode("utf-8", "surrogateescape") for w in dictionary], dtype=object), categorize=False)


def _packed(lang: str, numbers: _Numbers, ids: np.ndarray, follow: int, depth: int, buckets: int) -> Iterator[dict]:
    """Suffixes of a batch, combined and packed for each bucket, one bucket at a time."""
    suffixes = _suffixes(ids, follow, depth)
    if not len(suffixes):
        return
    dictionary = numbers.dictionary()
    hashed = _hashes(dictionary)
    ones = np.bincount(suffixes[:, 0], minlength=len(dictionary))
    alone = np.flatnonzero(ones).astype(np.int32)
    single = np.full((len(alone), depth), -1, np.int32)
    single[:, 0] = alone
    longer, counts = _combined(suffixes[suffixes[:, 1] >= 0] if depth > 1 else suffixes[:0])
    del suffixes
    rows = np.concatenate([single, longer])
    counts = np.concatenate([ones[alone], counts]).astype(np.int64)
    del longer
    mixed = hashed[rows[:, 0]]
    if depth > 1:
        second = np.where(rows[:, 1] >= 0, hashed[rows[:, 1]], np.uint64(0))
        mixed = (mixed ^ (second * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    del mixed
    order = np.argsort(bucket, kind="stable")
    rows, counts, bucket = rows[order], counts[order], bucket[order]
    del order
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    for lo, hi in zip(starts, [*starts[1:], len(rows)], strict=True):
        own = rows[lo:hi]
        used = np.unique(own)
        used = used[used >= 0]
        renumber = np.full(len(dictionary) + 1, -1, np.int32)  # the last place is that of -1
        renumber[used] = np.arange(len(used), dtype=np.int32)
        yield {"lang": lang, "bucket": int(bucket[lo]), "words": list(dictionary[used]),
               "sizes": counts[lo:hi].tobytes(), "suffixes": np.ascontiguousarray(renumber[own].T).tobytes()}


def _batches(batches: Iterable[pa.RecordBatch], depth: int, buckets: int, batch_bytes: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("words", pa.list_(pa.binary())),
                        ("sizes", pa.binary()), ("suffixes", pa.binary())])
    # words are numbered as they come, so that a batch is held as numbers and each word once
    held: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        while held:
            lang, (numbers, ids) = held.popitem()
            joined = np.concatenate(ids)
            del ids
            yield from send(_packed(lang, numbers, joined, 0, depth, buckets))
        release_memory()

    def send(rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
        some, n_bytes = [], 0
        for row in rows:
            some.append(row)
            n_bytes += len(row["sizes"]) + len(row["suffixes"]) + 16 * len(row["words"])
            if n_bytes >= SENT_BYTES:
                yield pa.RecordBatch.from_pylist(some, schema=schema)
                some, n_bytes = [], 0
        if some:
            yield pa.RecordBatch.from_pylist(some, schema=schema)

    for batch in batches:
        for lang, text in zip(*batch.columns, strict=True):
            data = text.as_py().encode("utf-8", "surrogatepass").translate(_TABLE)
            for words, follow in _slices(data, depth, batch_bytes):
                if follow:  # part of a long text: by itself, for the words that follow are not its own
                    numbers = _Numbers()
                    yield from send(_packed(lang.as_py(), numbers, numbers.of(words), follow, depth, buckets))
                    continue
                numbers, ids = held.setdefault(lang.as_py(), (_Numbers(), []))
                ids.append(numbers.of([*words, END]))
            size += len(data) + 16
            if size >= batch_bytes:
                yield from flush()
                size = 0
    yield from flush()


# the owner's side -----------------------------------------------------------------


def sort_suffixes(suffixes: np.ndarray, sizes: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Phrases of suffixes (rows of word numbers, -1 past the end): ``(words, first pointers, counts)``.

    Multikey three-way quicksort of pointers.  ``part`` numbers the partitions that are being sorted at one
    depth, all of one depth together: each takes a pivot, and its pointers go left, right, or into the equal
    part, which is one phrase; it is yielded and sorted by the next word if it has ``least`` occurrences.
    """
    depth = suffixes.shape[1]
    pointers = np.arange(len(suffixes), dtype=np.int64)
    starts = np.zeros(1 if len(pointers) else 0, np.int64)
    for d in range(depth):
        heads, counts, kept = [], [], []
        while len(pointers):
            part, key = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(pointers)])), suffixes[pointers, d]
            ends = np.r_[starts[1:], len(pointers)]
            middle = key[(starts + ends) // 2]
            first, last = key[starts], key[ends - 1]
            pivot = np.maximum(np.minimum(first, last), np.minimum(np.maximum(first, last), middle))  # the median of three
            side = np.sign(key - pivot[part]).astype(np.int8)
            # the equal parts are phrases
            equal = side == 0
            weight = np.bincount(part[equal], sizes[pointers[equal]], minlength=len(starts))
            known = (pivot >= 0) & (weight >= least)
            at = np.flatnonzero(equal)
            lead = at[np.searchsorted(part[at], np.arange(len(starts)))]  # the first pointer of each equal part
            if known.any():
                heads.append(pointers[lead[known]])
                counts.append(weight[known].astype(np.int64))
                if d + 1 < depth:
                    deeper = equal & known[part]
                    kept.append((pointers[deeper], np.bincount(part[deeper], minlength=len(starts))[known]))
            # the others are partitions of their own, left before right; abandoned if too small
            rest = ~equal
            own = part[rest] * 2 + (side[rest] > 0)
            order = np.argsort(own, kind="stable")
            own, pointers = own[order], pointers[rest][order]
            if len(pointers):
                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                weight = np.add.reduceat(sizes[pointers], starts)
                enough = weight >= least
                lengths = np.diff(np.r_[starts, len(pointers)])
                pointers = pointers[np.repeat(enough, lengths)]
                starts = np.r_[0, np.cumsum(lengths[enough])[:-1]].astype(np.int64) if enough.any() else starts[:0]
        if heads:
            yield d + 1, np.concatenate(heads), np.concatenate(counts)
        pointers = np.concatenate([p for p, _ in kept]) if kept else pointers[:0]
        lengths = np.concatenate([n for _, n in kept]) if kept else starts[:0]
        starts = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64) if len(lengths) else starts[:0]


def _counted(lang: str, rows: Iterable[tuple], depth: int, least: int) -> Iterator[dict]:
    """Phrases of one language and bucket, and its words in all (size 0); ``rows`` are taken in one at a time."""
    words: dict[bytes, int] = {}
    suffixes, sizes = [], []
    for own, size, packed in rows:
        number = np.array([words.setdefault(w, len(words)) for w in own] + [-1], np.int32)
        size = np.frombuffer(size, np.int64)
        suffixes.append(number[np.frombuffer(packed, np.int32).reshape(depth, len(size)).T])
        sizes.append(size)
    suffixes, sizes = np.concatenate(suffixes), np.concatenate(sizes)
    names = list(words)
    single = suffixes[:, 1] < 0 if depth > 1 else np.ones(len(sizes), bool)
    total = int(sizes[single].sum())
    if total:
        yield {"lang": lang, "size": 0, "phrase": "", "occurrences": total}
    # words were dealt by themselves, longer suffixes by their two leading words: the one are counted to depth 1
    for mine, deepest, from_size in ((single, 1, 1), (~single, depth, 2)):
        own = suffixes[mine][:, :deepest]
        for size, heads, counts in sort_suffixes(own, sizes[mine], least):
            if size >= from_size:
                for head, count in zip(own[heads][:, :size].tolist(), counts.tolist(), strict=True):
                    yield {"lang": lang, "size": size, "phrase": b" ".join(names[i] for i in head).decode("utf-8", "surrogatepass"),
                           "occurrences": count}


def phrase_counts(documents: DataFrame, most_words: int, least: int, batch_bytes: int = BATCH_BYTES,
                  bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """``(lang, size, phrase, occurrences)``, stored: phrases of 1 to ``most_words`` words with ``least`` occurrences
    or more; size 0 holds parts of the number of all words."""
    ship_package(documents.sparkSession)
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    # about six bytes a word, and two suffixes for each word
    characters = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 + int(characters // (6 * bucket_words))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(batches, most_words, buckets, batch_bytes)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby, islice

        schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("occurrences", pa.int64())])
        # a packed row is large: each is taken out of its batch when its turn comes
        rows = (tuple(batch.slice(at, 1).to_pylist()[0].values()) for batch in batches for at in range(batch.num_rows))
        for (_, lang), own in groupby(rows, key=lambda row: (row[1], row[0])):
            found = _counted(lang, (row[2:] for row in own), most_words, least)
            while some := list(islice(found, 10_000)):
                yield pa.RecordBatch.from_pylist(some, schema=schema)
        release_memory()

    packed = texts.mapInArrow(cut, PACKED)
    owned = packed.repartition(min(buckets, _partitions(documents)), "bucket").sortWithinPartitions("bucket", "lang")
    return stage(owned.mapInArrow(count, COUNTED), "phrases")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# scores ----------------------------------------------------------------------------


def _part(words: Column, start: int | Column, n: int | Column) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def collocations(documents: DataFrame, most_words: int = 3, least: int = 10, top: int = 2_000, covered: int = 50) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of 2 to ``most_words`` words of each language.

    ``covered``: a phrase is dropped if a longer one around it has at least that share, in per cent, of its occurrences.
    """
    counted = phrase_counts(documents, most_words, least)
    totals = counted.where("size = 0").groupBy("lang").agg(F.sum("occurrences").alias("n"))
    known = counted.where("size > 0").select("lang", "size", "phrase", F.col("occurrences").alias("f"))
    words = F.split("phrase", " ")
    candidates = known.where("size >= 2").withColumn("words", words)

    # every cut of every candidate, with the counts of both parts; the lowest score counts, then the first cut
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", F.col("f").alias("a"), "k",
        _part(F.col("words"), 1, F.col("k")).alias("before"),
        _part(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("after"))
    parts = lambda name, count: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    cuts = cuts.join(parts("before", "l"), ["lang", "before"]).join(parts("after", "r"), ["lang", "after"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.withColumn("over", F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")).cast("decimal(31,0)"))
    scored = scored.withColumn("under", (wide("l") * wide("r")).cast("decimal(38,0)")).withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # what every longer candidate covers
    inner = candidates.where("size > 2").select(
        "lang", "f", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inner = inner.select("lang", "f", "words", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at"))
    cover = (inner.select("lang", _part(F.col("words"), F.col("at"), F.col("m")).alias("phrase"), "f")
             .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = best.join(cover, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered))

    # a group limit before the shuffle: no more than ``top`` rows a language and task reach the ranking
    from pyspark.sql import Window

    best_first = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best_first).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                                              "n", F.col("cut.score").cast("long").alias("score"))


def oracle_sql(least: int = 10, top: int = 2_000, covered: int = 50) -> str:
    """The same for phrases of 2 to 3 words."""
    return rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
        grams AS (SELECT lang, unnest([w[i], CASE WHEN i + 1 <= len(w) THEN concat(w[i], ' ', w[i + 1]) END,
                                       CASE WHEN i + 2 <= len(w) THEN concat(w[i], ' ', w[i + 1], ' ', w[i + 2]) END]) AS phrase,
                         unnest([1, 2, 3]) AS size FROM places),
        counts AS MATERIALIZED (SELECT lang, phrase, size, count(*) AS f FROM grams WHERE phrase IS NOT NULL GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
        candidates AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2 AND f >= {least}),
        parts AS MATERIALIZED (
            SELECT lang, phrase, size, f AS a, 1 AS k, w[1] AS before, array_to_string(w[2:], ' ') AS after
            FROM candidates UNION ALL
            SELECT lang, phrase, size, f, 2, array_to_string(w[1:2], ' '), w[3] FROM candidates WHERE size = 3),
        lefts AS MATERIALIZED (SELECT c.*, l.f AS l FROM parts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.before),
        cuts AS MATERIALIZED (
            SELECT c.*, r.f AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * r.f) AS score
            FROM lefts c JOIN counts r ON r.lang = c.lang AND r.phrase = c.after),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        cover AS (SELECT lang, phrase, max(f) AS longer FROM (
                      SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM candidates WHERE size = 3 UNION ALL
                      SELECT lang, array_to_string(w[2:3], ' '), f FROM candidates WHERE size = 3) GROUP BY ALL),
        ranked AS (
            SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
            FROM best b LEFT JOIN cover v ON v.lang = b.lang AND v.phrase = b.phrase
            WHERE longer IS NULL OR 100 * longer < {covered} * a)
        SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN totals USING (lang) WHERE rank <= {top}"""
