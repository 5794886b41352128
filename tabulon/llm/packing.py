"""Operator 9: best-fit packing by a configuration linear program over the length histogram.

A *pattern* is a multiset of piece lengths that fits one sequence.  The program
asks for the fewest patterns that cover the histogram.  Multiplicative weights
solve it: every length has a price that falls exponentially with its share covered; each
step prices the best pattern by knapsack dynamic programming and uses it for a small share of a length.
The steps add up to a fractional cover, and the prices give a lower bound on any; passes
are repeated with finer steps until both are within ``GAP``, or ``MOST_STEPS`` are used up.
The uses are rounded down, fullest patterns first; the rounds repeat
while they place half of what is left, and the last pieces (a number that
depends on the number of patterns, not on the data) are placed best-fit, longest first.
Plain best fit of all pieces is taken where it needs fewer sequences.

Only the histogram (at most ``capacity`` rows) reaches the driver, and only the
pattern table, bounded by the capacity in the same way, goes out.
Spark numbers the pieces of each length: ``length`` is split into slices by a
stored salt, so that no length, however frequent, is one group; number and
pattern table give sequence and offset.

Null and empty texts are one piece holding the end id.  A text longer than the
capacity is cut into full pieces, the first one shorter where it does not divide.
Repeated rows are pieces of their own.  An empty table gives no rows.  Extra
columns of the piece table are carried along by ``pack``.
"""

from __future__ import annotations

import bisect
import json
import math
import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import file_bytes, fresh, map_texts
from tabulon.llm.token_counts import byte_symbols
from tabulon.session import ship_package, stage

#: Chunks remembered per Python worker, and the longest one worth remembering.
CACHE_ENTRIES = 250_000
CACHE_CHARS = 32
#: Start prices favour long pieces a little.
TILT = 1.02
#: The fractional cover is within this share of its bound; a step takes the dearest pattern up to SLACK.
GAP = 0.01
SLACK = 0.002
#: After the first pass, a step lowers no logarithm of a price by more than this.
STEP = 0.02
#: No pass is begun that would take the steps beyond this; the cover may then be further than GAP from its bound.
MOST_STEPS = 200_000
#: Up to so many pieces left over are placed best-fit rather than by patterns with much waste.
BEST_FIT_PIECES = 20_000
#: Pieces of one length that are numbered together, at least.
SLICE_ROWS = 1_000


class ChunkEncoder:
    """Ids of texts under a byte-level BPE vocabulary (``tokenizers`` JSON bytes), as uint32 bytes.

    A word with the blank before it is tokenized alone, and a line feed between
    two words is a token; so blank-separated chunks are encoded once and
    remembered.  New chunks go through ``tiktoken`` with the same vocabulary,
    whose ids are its merge ranks.  Texts with other or repeated white space,
    or with a special string, are encoded whole by ``tokenizers``.
    """

    def __init__(self, vocabulary: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_buffer(vocabulary)
        spec = json.loads(vocabulary)
        as_byte = {c: b for b, c in enumerate(byte_symbols())}
        ids = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        in_order = all(ids[a + b] == 256 + i for i, (a, b) in enumerate(pairs))
        pre = spec["pre_tokenizer"]
        self.by_chunk = (spec["normalizer"] is None and in_order and pre["type"] == "ByteLevel"
                         and pre["use_regex"] and not pre["add_prefix_space"])
        self.specials = [t["content"] for t in spec["added_tokens"]]
        if self.by_chunk:
            ranks = {bytes(as_byte[c] for c in token): i for token, i in ids.items()
                     if token not in self.specials}
            self.ranked = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks,
                                            special_tokens={}).encode_ordinary
        self.heads, self.tails = _Chunks(self, ""), _Chunks(self, " ")
        self.line_feed = self.whole("\n")

    def forget(self) -> None:
        """Drops the remembered chunks; a worker that waits between tasks holds the vocabulary only."""
        self.heads.clear()
        self.tails.clear()

    def whole(self, text: str) -> bytes:
        return array("I", self.model.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        if not self.by_chunk or any(s in text for s in self.specials):
            return self.whole(text)
        head, tail = self.heads, self.tails.__getitem__
        try:
            out = []
            for line in text.split("\n"):
                chunks = line.split(" ")
                out.append(head[chunks[0]] + b"".join(map(tail, chunks[1:])))
            return self.line_feed.join(out)
        except _NotAChunk:
            return self.whole(text)


class _NotAChunk(Exception):
    """The chunk is empty or has white space at an end: its neighbours matter."""


class _Chunks(dict):
    """Ids by chunk, each with ``lead`` before it; starts afresh when full."""

    def __init__(self, encoder: ChunkEncoder, lead: str):
        self.encoder, self.lead = encoder, lead

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _NotAChunk
        ids = array("I", self.encoder.ranked(self.lead + chunk)).tobytes()
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[chunk] = ids
        return ids


_ENCODERS: dict[bytes, ChunkEncoder] = {}


def encoder_for(vocabulary: bytes) -> ChunkEncoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary] = ChunkEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def piece_table(docs: DataFrame, vocabulary_path: str, capacity: int, end_id: int,
                id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` (and ``ids``): every document's ids cut to the capacity."""
    vocabulary = file_bytes(docs.sparkSession, vocabulary_path)
    end = np.array([end_id], "<u4").tobytes()

    def make():
        encoder = encoder_for(vocabulary.value)

        def work(texts: list[str]) -> list[pa.Array]:
            starts, lengths, crcs, ids = [], [], [], []
            for body in map(encoder.encode, texts):
                data = memoryview(body + end)
                n = len(data) // 4
                first = n % capacity or capacity
                cuts = [0, *range(first, n + 1, capacity)]
                spans = list(zip(cuts, cuts[1:], strict=False))
                starts.append([a for a, _ in spans])
                lengths.append([b - a for a, b in spans])
                crcs.append([zlib.crc32(data[4 * a:4 * b]) for a, b in spans])
                if with_ids:
                    ids.append([np.frombuffer(data[4 * a:4 * b], "<u4").astype(np.int64) for a, b in spans])
            longs = pa.list_(pa.int64())
            out = [pa.array(x, longs) for x in (starts, lengths, crcs)]
            return [*out, pa.array(ids, pa.list_(longs))] if with_ids else out

        work.close = encoder.forget
        return work

    names = ["start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    sql = [f"{n} array<{'array<bigint>' if n == 'ids' else 'bigint'}>" for n in names]
    cut = map_texts(docs, [id_col], text_col, make, ", ".join(sql))
    return (cut.select(id_col, F.posexplode(F.arrays_zip(*names)).alias("piece", "p"))
            .select(id_col, "piece", *(F.col(f"p.{n}").alias(n) for n in names)))


# the linear program --------------------------------------------------------------


def best_pattern(prices: np.ndarray) -> dict[int, int]:
    """The dearest multiset of lengths that fits: ``prices[l]`` by length, 0 and absent lengths negative."""
    capacity = len(prices) - 1
    value = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        worth = value[room - 1::-1] + prices[1:room + 1]
        best = int(worth.argmax())
        if worth[best] > value[room - 1]:
            value[room], taken[room] = worth[best], best + 1
        else:
            value[room] = value[room - 1]
    pattern: dict[int, int] = {}
    room = capacity
    while room > 0:
        if taken[room]:
            pattern[int(taken[room])] = pattern.get(int(taken[room]), 0) + 1
            room -= int(taken[room])
        else:
            room -= 1
    return pattern


def fractional_patterns(counts: np.ndarray, gap: float = GAP) -> tuple[list[tuple[dict[int, int], float]], float]:
    """Multiplicative weights on the covering program: (pattern, fractional uses) that cover ``counts``, and a bound.

    A length's price falls exponentially with the share of it that is covered, so those that lag behind
    become dear.  A step uses a pattern that is dearest up to ``SLACK`` until some length in it is covered by a
    small share more; the uses of all steps add up to the cover.  No cover is smaller than the
    worth of the counts over that of the dearest pattern, at any prices.  Passes start from the
    mean prices of the last, which fall four times as fast, until the cover is within ``gap`` of the best such
    bound (or ``MOST_STEPS`` are used up: many lengths without even near-full patterns).
    """
    capacity = len(counts) - 1
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return [], 0.0
    need = counts[lengths].astype(float)
    at_length = np.full(capacity + 1, -1)
    at_length[lengths] = np.arange(len(lengths))
    pool: dict[tuple, int] = {}
    keys: list[tuple] = []
    rows = np.zeros((64, len(lengths)))
    start = (lengths / capacity) ** TILT
    bound = float(need @ lengths) / capacity
    best: tuple[float, dict[tuple, float]] = (math.inf, {})

    def dearest(prices: np.ndarray) -> tuple[tuple, float]:
        by_length = np.full(capacity + 1, -1.0)
        by_length[lengths] = np.where(prices > 0, prices, -1.0)
        pattern = best_pattern(by_length)
        worth = sum(k * by_length[n] for n, k in pattern.items())
        # no more of a length than there is of it
        return tuple(sorted(((n, min(k, int(counts[n]))) for n, k in pattern.items()), reverse=True)), worth

    rate, steps = 1.0, 0
    while True:
        left, uses, total, top = np.ones(len(lengths)), {}, 0.0, math.inf
        mean = np.zeros(len(lengths))
        while (left > 0).any():
            prices = np.where(left > 0, start * np.exp(rate * (left - 1)), 0.0)
            worths = rows[:len(pool)] @ prices
            at = int(worths.argmax()) if len(pool) else -1
            if at < 0 or worths[at] < top * (1 - SLACK):  # prices only fall in a pass, so `top` stays a bound
                key, top = dearest(prices)
                steps += 100  # about as dear as so many steps
                if steps > MOST_STEPS and best[1]:
                    return [(dict(key), use) for key, use in best[1].items()], bound
                bound = max(bound, float(need @ prices) / top)
                if key not in pool:
                    if len(pool) == len(rows):
                        rows = np.vstack([rows, np.zeros_like(rows)])
                    for n, k in key:
                        rows[len(pool), at_length[n]] = k
                    pool[key] = len(pool)
                    keys.append(key)
                at = pool[key]
            key = keys[at]
            used = np.flatnonzero(rows[at] * (left > 0))
            share = rows[at, used] / need[used]
            step = float((np.minimum(left[used], STEP / rate if rate > 1 else 1.0) / share).min())
            left[used] -= step * share
            left[left < 1e-9] = 0.0
            live = tuple((n, k) for n, k in key if prices[at_length[n]] > 0)
            uses[live] = uses.get(live, 0.0) + step
            total += step
            steps += 1
            mean += step * prices / top
        if total < best[0]:
            best = total, uses
        bound = max(bound, float(need @ mean) / dearest(mean)[1])
        start = mean / mean.max()
        rate *= 4
        if best[0] <= max((1 + gap) * bound, bound + 1) or steps + len(lengths) * rate / STEP > MOST_STEPS:
            return [(dict(key), use) for key, use in best[1].items()], bound


def best_fit_runs(counts: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first: (pattern, times), equal sequences filled together, so any number of pieces."""
    capacity = len(counts) - 1
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}  # by free room
    rooms: list[int] = []
    done: list[tuple[dict[int, int], int]] = []

    def put(pattern: dict[int, int], times: int, room: int) -> None:
        if times and room not in open_:
            bisect.insort(rooms, room)
            open_[room] = []
        if times:
            open_[room].append((pattern, times))

    for n in range(capacity, 0, -1):
        left = int(counts[n])
        while left:
            at = bisect.bisect_left(rooms, n)
            if at == len(rooms):
                pattern, times, room = {}, left, capacity  # as many new ones as could be needed
            else:
                room = rooms[at]
                pattern, times = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            fill = room // n  # a sequence just added to is the tightest, until no more fits
            whole = min(times, left // fill)
            put({**pattern, n: fill}, whole, room - fill * n)
            left -= whole * fill
            if whole < times and left:
                put({**pattern, n: left}, 1, room - left * n)
                left, whole = 0, whole + 1
            if pattern:
                put(pattern, times - whole, room)
    for runs in open_.values():
        done += runs
    return done


def best_fit(counts: np.ndarray) -> list[dict[int, int]]:
    """One pattern per sequence of ``best_fit_runs``."""
    return [pattern for pattern, times in best_fit_runs(counts) for _ in range(times)]


def _rounded(counts: np.ndarray, found: list[tuple[dict[int, int], float]], most_spare: int):
    """Whole uses of the fractional patterns ``found``, fullest first, in rounds; what is left is placed best-fit."""
    capacity = len(counts) - 1
    left = counts.copy()
    chosen: list[tuple[dict[int, int], int]] = []
    while left.any():
        total = left.sum()
        waste = [capacity - sum(n * k for n, k in pattern.items()) for pattern, _ in found]
        for (pattern, x), spare in sorted(zip(found, waste, strict=True), key=lambda p: (p[1], -p[0][1])):
            times = min(int(x + 1e-6), *(int(left[n]) // k for n, k in pattern.items()))
            if times > 0 and (spare <= most_spare or left.sum() > BEST_FIT_PIECES):
                chosen.append((pattern, times))
                for n, k in pattern.items():
                    left[n] -= k * times
        if left.sum() > total // 2 or left.sum() <= BEST_FIT_PIECES:
            break
        found, _ = fractional_patterns(left, math.inf)  # one pass
    return chosen + best_fit_runs(left)


def plan(counts: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """(pattern, times) that hold exactly ``counts[l]`` pieces of each length ``l``.

    The fewest sequences of: the program's patterns rounded, without or with those that waste
    much for the last pieces, and plain best fit.
    """
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    full = int(left[capacity])
    left[capacity] = 0
    found, _ = fractional_patterns(left)
    plans = [_rounded(left, found, capacity // 128), _rounded(left, found, capacity), best_fit_runs(left)]
    chosen = min(plans, key=lambda p: sum(times for _, times in p))
    return ([({capacity: 1}, full)] if full else []) + chosen


def slots(chosen: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first number, first sequence, copies per sequence, offset), sorted."""
    rows, number, sequence = [], {}, 0
    for pattern, times in chosen:
        offset = 0
        for n in sorted(pattern, reverse=True):
            rows.append((n, number.get(n, 0), sequence, pattern[n], offset))
            number[n] = number.get(n, 0) + pattern[n] * times
            offset += n * pattern[n]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


# the distributed part -----------------------------------------------------------


def pack(pieces: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; lengths are between 1 and the capacity."""
    spark = pieces.sparkSession
    ship_package(spark)
    salt, part, number, before = fresh(pieces, "salt", "part", "number", "before")
    stored = stage(pieces.withColumn(salt, (F.rand() * (1 << 30)).cast("int")), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in stored.groupBy(length_col).count().collect():  # one row per length, at most `capacity`
        counts[row[0]] = row[1]
    table = spark.sparkContext.broadcast(slots(plan(counts)))

    width = np.maximum(SLICE_ROWS, np.sqrt(counts)).astype(np.int64)
    slices = F.lit([int(-(-n // w)) or 1 for n, w in zip(counts, width, strict=True)])
    sliced = stored.withColumn(part, F.col(salt) % F.get(slices, F.col(length_col).cast("int")))
    sizes = sliced.groupBy(length_col, part).count()
    offsets = sizes.select(length_col, part, (F.sum("count").over(
        Window.partitionBy(length_col).orderBy(part)) - F.col("count")).alias(before))
    order = [c for c in [salt, *pieces.columns] if dict(sliced.dtypes)[c] not in ("map", "variant")]
    numbered = sliced.withColumn(
        number, F.row_number().over(Window.partitionBy(length_col, part).orderBy(*order)) - F.lit(1))
    numbered = (numbered.join(offsets, [length_col, part])
                .withColumn(number, F.col(number) + F.col(before))
                .select(*pieces.columns, number))
    out_names = [*pieces.columns, "sequence_id", "offset"]
    at_length = numbered.columns.index(length_col)

    def place(batches):
        rows = table.value
        stride = int(rows[:, 1].max()) + 1 if len(rows) else 1
        keys = rows[:, 0] * stride + rows[:, 1]
        for batch in batches:
            length = batch.column(at_length).to_numpy(zero_copy_only=False).astype(np.int64)
            n = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * stride + np.minimum(n, stride - 1), side="right") - 1
            slot = rows[at]
            n = n - slot[:, 1]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(slot[:, 2] + n // slot[:, 3]),
                 pa.array(slot[:, 4] + n % slot[:, 3] * length)],
                names=out_names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return numbered.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")
