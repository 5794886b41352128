"""Operator 1: token counts by byte-pair merging, without making identifiers.

A word starts as one symbol per UTF-8 byte, the last one carrying the end-of-word
mark.  A heap holds the adjacent pairs by merge rank and a linked list the live
symbols: pop the lowest rank (leftmost on ties), join the two symbols, push the
two new neighbours.  The count of a word is its initial symbols minus its merges.

The vocabulary file gives the merge ranks, the word pattern's special strings
and the end-of-word mark.  Text is normalised as the file says (NFC, white space
to blanks, lower case) and cut into words by the file's pattern; special strings
inside a text count as one token each.  White space always ends a word, so whole
blank-separated chunks are counted once per worker and remembered.

Null and empty texts have 0 tokens and 0 bytes.  A text of any length is
processed whole.  Repeated rows and repeated ids give one row each.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.normalizers import Normalizer

from tabulon.llm.common import file_bytes, map_texts

#: Chunks remembered per Python worker, and the longest one worth remembering.
CACHE_ENTRIES = 500_000
CACHE_CHARS = 48
#: White space to Python's ``split`` that Unicode does not call white space.
ODD_SPACE = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else 256 and up in order."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Merges that byte-pair encoding performs on ``symbols``."""
    n = len(symbols)
    symbols = symbols[:]
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = right[i]
        if not symbols[i] or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
            continue  # one of the two has been merged away since
        symbols[i] += symbols[j]
        symbols[j] = ""
        merges += 1
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i))
        h = left[i]
        if h >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return merges


class _Memo(dict):
    """Remembers short keys up to a bound, then starts afresh."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[key] = value
        return value


def normalizer_of(spec: dict) -> Normalizer:
    """The vocabulary's normaliser alone, from a tokenizer without words."""
    bare = {**spec, "added_tokens": [], "post_processor": None, "decoder": None,
            "model": {"type": "BPE", "vocab": {}, "merges": []}}
    return Tokenizer.from_str(json.dumps(bare)).normalizer


class WordCounter:
    """Counts the tokens of texts under a word-level BPE vocabulary (``tokenizers`` JSON bytes)."""

    def __init__(self, vocabulary: bytes):
        spec = json.loads(vocabulary)
        model = spec["model"]
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.normalizer = normalizer_of(spec)
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.mark = model.get("end_of_word_suffix") or ""
        self.bytes = byte_symbols()
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(split["pattern"]["Regex"])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special)))
        self.starts = {s[0] for s in special}
        self.by_word = _Memo(self.count_word)
        self.by_chunk = _Memo(self.count_plain)

    def count_word(self, word: str) -> int:
        symbols = [self.bytes[b] for b in word.encode()]
        symbols[-1] += self.mark
        return len(symbols) - merge_count(symbols, self.ranks)

    def count_plain(self, text: str) -> int:
        """Tokens of text without special strings."""
        # other than ASCII by the library's own normaliser: its tables are of another Unicode version than Python's
        text = text.lower() if text.isascii() else self.normalizer.normalize_str(text)
        return sum(self.by_word[m.group()] for m in self.words.finditer(text))

    def count(self, text: str) -> int:
        total = 0
        if "<|" in text or not self.starts <= {"<"}:
            rest = self.special.split(text)
            total = len(rest) - 1
        else:
            rest = (text,)
        for part in rest:
            if ODD_SPACE.search(part):
                total += self.count_plain(part)
            else:
                if part.isascii():
                    part = part.lower()
                total += sum(map(self.by_chunk.__getitem__, part.split()))
        return total


_COUNTERS: dict[bytes, WordCounter] = {}


def counter_for(vocabulary: bytes) -> WordCounter:
    """One counter, with its memory, per Python worker and vocabulary."""
    if vocabulary not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[vocabulary] = WordCounter(vocabulary)
    return _COUNTERS[vocabulary]


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    vocabulary = file_bytes(docs.sparkSession, vocabulary_path)

    def make():
        counter = counter_for(vocabulary.value)

        def work(texts: list[str]) -> list[pa.Array]:
            return [pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64()),
                    pa.array([counter.count(t) for t in texts], pa.int64())]

        return work

    counted = map_texts(docs, [id_col], text_col, make, "n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
