"""Operator 5: SentencePiece encoding with source offsets, and decoding.

Normalisation walks the source text by longest prefix through the model's
compiled character map (a double-array trie plus replacement strings; an empty
map copies characters) and records, for every byte of normalised text, the
source byte it came from.  Blanks become the blank mark, a dummy blank is put in
front, surplus blanks are removed if the model says so.  Byte-pair merging then
joins the adjacent pair with the best score (leftmost on ties) until none is
left; characters without a piece become byte pieces.  Each piece is projected
through the alignment to the source bytes it covers: piece ``i`` covers
``bounds[i]`` to ``bounds[i + 1]``; of the byte pieces of one character only the
last covers it.

No piece of the usual models has a blank mark after another character, nor a
line feed, so no merge crosses the start of a word or a line feed; with the empty map,
chunks between them are encoded once per worker and remembered.  Models or texts
without that property take the same steps over the whole text.

Decoding joins the pieces, drops the dummy blank, turns blank marks into blanks
and byte runs into characters (U+FFFD for each byte that is not part of one).

Null and empty texts encode to no ids, the bounds ``[0]`` and decode to an empty text.
Texts of any length are processed whole; repeated rows give one row each.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import file_bytes, map_texts

MARK = "▁"
MARK_BYTES = MARK.encode()
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Chunks remembered per Python worker, and the longest one worth remembering.
CACHE_ENTRIES = 800_000
CACHE_CHARS = 48
#: Up to so many symbols a scan of the pair scores is faster than a heap.
SHORT = 32
NO_PIECE = float("-inf")


def _fields(data: bytes) -> Iterable[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at:at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            yield key >> 3, data[at:at + size]
            at += size


class CharMap:
    """The compiled character map: longest prefix of source bytes to a replacement."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.replacements = blob[4 + size:] if blob else b""

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest entry that starts at ``at``."""
        if not self.units:
            return None

        def child_base(pos: int, unit: int) -> int:
            return pos ^ ((unit >> 10) << ((unit & 0x200) >> 6))

        found = None
        pos = child_base(0, self.units[0])
        for i in range(at, len(source)):
            label = source[i]
            pos ^= label
            unit = self.units[pos]
            if unit & 0x800000FF != label:
                break
            pos = child_base(pos, unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[pos] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.replacements[start:self.replacements.index(b"\0", start)]


@dataclass
class Normalised:
    text: str
    origin: list[int]  # source byte of each byte of ``text``, and one past the end


class PieceCodec:
    """Encoder and decoder for one SentencePiece BPE model (the bytes of its ``.model`` file)."""

    def __init__(self, model: bytes):
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [-1] * 256
        self.surfaces: list[bytes] = []
        self.kinds: list[int] = []
        self.unknown = 0
        self.user_defined: list[str] = []
        normaliser, trainer = b"", b""
        for number, value in _fields(model):
            if number == 1:
                self._add_piece(dict(_fields(value)))
            elif number == 2:
                trainer = value
            elif number == 3:
                normaliser = value
        train = dict(_fields(trainer))
        if train.get(3, 1) != 2:
            raise ValueError("only BPE models are supported")
        if self.user_defined or train.get(24) or UNUSED in self.kinds:
            raise ValueError("user-defined and unused pieces and blanks as suffix are not supported")
        self.unknown_surface = train.get(44, " ⁇ ".encode())
        self.controls = {i for i, kind in enumerate(self.kinds) if kind == CONTROL}
        norm = dict(_fields(normaliser))
        self.map = CharMap(norm.get(2, b""))
        self.dummy, self.trim, self.escape = norm.get(3, 1), norm.get(4, 1), norm.get(5, 1)
        if not self.escape:
            raise ValueError("models that keep blanks unescaped are not supported")
        inner = [p for p in self.scores if MARK in p.lstrip(MARK) or "\n" in p]
        self.by_chunk = not inner and not self.map.units and self.dummy and not self.trim
        self.heads, self.tails = _Chunks(self, False), _Chunks(self, True)
        self.line_feed = self.pack("\n") if self.by_chunk else b""

    def _add_piece(self, fields: dict) -> None:
        text = fields[1].decode()
        score = struct.unpack("<f", fields[2])[0] if 2 in fields else 0.0
        kind = fields.get(3, NORMAL)
        at = len(self.kinds)
        self.kinds.append(kind)
        surface = text.replace(MARK, " ").encode()
        if kind == BYTE:
            value = int(text[3:5], 16)
            self.byte_ids[value] = at
            surface = bytes([value])
        elif kind == UNKNOWN:
            self.unknown = at
        elif kind == CONTROL:
            surface = b""
        elif kind == USER_DEFINED:
            self.user_defined.append(text)
        else:
            self.scores[text] = score
            self.ids[text] = at
        self.surfaces.append(surface)

    # normalisation ----------------------------------------------------------------

    def normalise(self, text: str) -> Normalised:
        source = text.encode()
        out: list[bytes] = []
        origin: list[int] = []
        at = 0
        pieces: list[tuple[bytes, int, int]] = []
        while at < len(source):
            hit = self.map.longest(source, at)
            if hit is None:
                first = source[at]
                width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                hit = width, source[at:at + width]
            pieces.append((hit[1], at, at + hit[0]))
            at += hit[0]
        if self.trim:  # leading blanks
            lead = next((i for i, p in enumerate(pieces) if p[0] != b" "), len(pieces))
            pieces = pieces[lead:]
        if not pieces:
            return Normalised("", [0])
        after_blank = bool(self.trim)
        if self.dummy:
            out.append(MARK_BYTES)
            origin += [pieces[0][1]] * 3
        end = pieces[0][1]
        for new, start, stop in pieces:
            if after_blank:
                new = new.lstrip(b" ")
            for b in new:
                if b == 0x20:
                    out.append(MARK_BYTES)
                    origin += [start] * 3
                else:
                    out.append(bytes([b]))
                    origin.append(start)
            if new:
                after_blank = bool(self.trim) and new.endswith(b" ")
            end = stop
        data = b"".join(out)
        if self.trim:
            while data.endswith(MARK_BYTES):
                data = data[:-3]
                end = origin[len(data)]
                origin = origin[:len(data)]
        return Normalised(data.decode("utf-8", "replace"), [*origin, end])

    # encoding ---------------------------------------------------------------------

    def merge(self, text: str) -> list[str]:
        """Pieces of normalised text: best-scored adjacent pair first, leftmost on ties."""
        symbols = list(text)
        n = len(symbols)
        if n <= SHORT:
            return self._merge_short(symbols)
        right = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        scores = self.scores
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in scores:
                heap.append((-scores[pair], i, len(pair)))
        heapq.heapify(heap)

        def push(i: int, j: int) -> None:
            pair = symbols[i] + symbols[j]
            if pair in scores:
                heapq.heappush(heap, (-scores[pair], i, len(pair)))

        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i]
            if not symbols[i] or j >= n or len(symbols[i]) + len(symbols[j]) != size:
                continue  # stale: a neighbour was merged since
            symbols[i] += symbols[j]
            symbols[j] = ""
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                push(i, k)
            if left[i] >= 0:
                push(left[i], i)
        return [s for s in symbols if s]

    def _merge_short(self, symbols: list[str]) -> list[str]:
        """``merge`` for a few symbols, where scanning the pair scores beats a heap."""
        get = self.scores.get
        found = [get(a + b, NO_PIECE) for a, b in zip(symbols, symbols[1:], strict=False)]
        while found:
            best = max(found)
            if best == NO_PIECE:
                break
            i = found.index(best)
            symbols[i] += symbols.pop(i + 1)
            del found[i]
            if i < len(found):
                found[i] = get(symbols[i] + symbols[i + 1], NO_PIECE)
            if i:
                found[i - 1] = get(symbols[i - 1] + symbols[i], NO_PIECE)
        return symbols

    def pieces(self, text: str) -> Iterable[tuple[int, int]]:
        """(id, normalised bytes covered) of each piece of normalised text."""
        for piece in self.merge(text):
            at = self.ids.get(piece)
            raw = piece.encode()
            if at is not None:
                yield at, len(raw)
            elif self.byte_ids[0] >= 0:
                for b in raw[:-1]:
                    yield self.byte_ids[b], 0
                yield self.byte_ids[raw[-1]], len(raw)
            else:
                yield self.unknown, len(raw)

    def pack(self, normal: str, blank_bytes: int = 3) -> bytes:
        """(id, bytes covered) pairs as int32; a leading blank mark counts ``blank_bytes``."""
        flat: list[int] = []
        for pair in self.pieces(normal):
            flat += pair
        if blank_bytes != 3 and flat and normal[0] == MARK:
            flat[1] += blank_bytes - 3
        return array("i", flat).tobytes()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): piece ``i`` covers source bytes ``bounds[i]`` to ``bounds[i + 1]``."""
        if not text:
            return np.zeros(0, "<i4"), np.zeros(1, "<i4")
        if self.by_chunk and MARK not in text:
            try:
                packed = self._encode_chunks(text)
                pairs = np.frombuffer(packed, "<i4").reshape(-1, 2)
                bounds = np.zeros(len(pairs) + 1, "<i4")
                np.cumsum(pairs[:, 1], out=bounds[1:])
                return pairs[:, 0], bounds
            except _NotAChunk:
                pass
        normal = self.normalise(text)
        if not normal.text:
            return np.zeros(0, "<i4"), np.asarray(normal.origin[-1:], "<i4")
        parts = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", normal.text) if self.by_chunk else [normal.text]
        pairs = np.array([p for part in parts for p in self.pieces(part)], "<i4").reshape(-1, 2)
        ends = np.concatenate([[0], np.cumsum(pairs[:, 1])])
        return pairs[:, 0], np.asarray(normal.origin, "<i4")[ends]

    def _encode_chunks(self, text: str) -> bytes:
        out = []
        tails = self.tails.__getitem__
        first = True
        for line in text.split("\n"):
            chunks = line.split(" ")
            if first:
                out.append(self._first(chunks[0]))
                first = False
            else:
                out.append(self.line_feed)
                if chunks[0]:
                    out.append(self.heads[chunks[0]])
            out.extend(map(tails, chunks[1:]))
        return b"".join(out)

    def _first(self, chunk: str) -> bytes:
        if not chunk:
            raise _NotAChunk
        return self.pack(MARK + chunk, 0)

    # decoding ---------------------------------------------------------------------

    def _decode_around(self, ids: list[int]) -> str:
        """``decode`` where control pieces, which leave no text, end runs of byte pieces."""
        text, run = "", []
        for i in [*ids, *self.controls][:len(ids) + 1]:
            if i in self.controls:
                text += self.decode(run, not text)
                run = []
            else:
                run.append(i)
        return text

    def decode(self, ids: list[int], drop_blank: bool = True) -> str:
        if not ids:
            return ""
        if not self.controls.isdisjoint(ids):
            return self._decode_around(ids)
        raw = b"".join(map(self.surfaces.__getitem__, ids))
        if self.unknown in ids:
            raw = b"".join(self.unknown_surface if i == self.unknown else self.surfaces[i] for i in ids)
        if drop_blank and self.dummy and self.kinds[ids[0]] == NORMAL and raw.startswith(b" "):
            raw = raw[1:] if not self.trim else raw.lstrip(b" ")
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            return _each_bad_byte(raw)
        return text


def _each_bad_byte(raw: bytes) -> str:
    """UTF-8 with U+FFFD for every single byte that is not part of a character."""
    return re.sub("[\udc80-\udcff]", "\ufffd", raw.decode("utf-8", "surrogateescape"))


class _NotAChunk(Exception):
    """The chunk has neighbours that merges may reach across."""


class _Chunks(dict):
    """Packed pieces by chunk; ``blank`` chunks follow a single blank."""

    def __init__(self, codec: PieceCodec, blank: bool):
        self.codec, self.blank = codec, blank

    def __missing__(self, chunk: str) -> bytes:
        if not chunk:
            raise _NotAChunk
        packed = self.codec.pack(MARK + chunk, 1) if self.blank else self.codec.pack(chunk)
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[chunk] = packed
        return packed


_CODECS: dict[bytes, PieceCodec] = {}


def codec_for(model: bytes) -> PieceCodec:
    """One codec, with its memory, per Python worker and model."""
    if model not in _CODECS:
        _CODECS.clear()
        _CODECS[model] = PieceCodec(model)
    return _CODECS[model]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(flat, np.int32)))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """``id, ids, bounds`` of every row; with ``decoded`` also the text that its ids decode to."""
    model = file_bytes(docs.sparkSession, model_path)

    def make():
        codec = codec_for(model.value)

        def work(texts: list[str]) -> list[pa.Array]:
            done = [codec.encode(t) for t in texts]
            out = [_lists([ids for ids, _ in done]), _lists([bounds for _, bounds in done])]
            if decoded:
                out.append(pa.array([codec.decode(ids.tolist()) for ids, _ in done], pa.string()))
            return out

        return work

    return map_texts(docs, [id_col], text_col, make,
                     "ids array<int>, bounds array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, decoded`` of every row of ids (null: an empty text)."""
    model = file_bytes(encoded.sparkSession, model_path)

    def make():
        codec = codec_for(model.value)
        return lambda rows: [pa.array([codec.decode(list(ids)) for ids in rows], pa.string())]

    return map_texts(encoded, [id_col], ids_col, make, "decoded string")


def piece_spans(bounds: str = "bounds"):
    """Column of ``struct<start, end>``: the source bytes of each piece."""
    b = F.col(bounds)
    return F.zip_with(F.slice(b, 1, F.size(b) - 1), F.slice(b, 2, F.size(b) - 1),
                      lambda s, e: F.struct(s.alias("start"), e.alias("end")))


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of ``encode(..., decoded=True)``."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        F.element_at("bounds", -1).cast("long").alias("covered_bytes"))
