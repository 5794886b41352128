r"""Operator 6: secret scans through a recursive decoding worklist.

Three patterns are searched in the text itself (base spans) and in every layer that
decoding uncovers: URL escapes, Unicode escapes (``\uXXXX``, ``\u{...}``, ``\xXX``,
``&#...;``, named entities of ASCII characters), base64 runs (both alphabets, also wrapped) and compressed bytes (gzip,
zlib, bz2, xz) inside them.  A base64 run may follow other characters of its alphabet, so it is decoded from each of its
first four characters, and compressed bytes may begin anywhere in it.  Its lines may be parted by line breaks, also
written as escapes, with blanks around them, or by blanks alone if the first two have equal width, ``WORD_LEAST`` at least.
Each layer carries, for every character, the span of the text that it came
from, so a match in a nested layer is reported as a span of the text.  Layers go
on a worklist until none is new; content seen before for the same source span is not
taken again, so cycles end.  Every byte of a
layer is read: one that is not UTF-8 is a character of its own, and a bad escape is U+FFFD.

Within a kind, base matches are leftmost and do not overlap; short ones are
dropped after matching.  Spans count code points, the end is exclusive.  Null and empty
texts have no spans.  Texts are scanned whole; of a compressed layer about
``LAYER_BYTES`` are unpacked at a time, all members one after another, and a compressed layer
inside it is fed from these pieces.  Pieces overlap and are cut outside of encoded runs only, so a
run longer than a piece is held whole; only one that is wrapped with blanks may be cut there.  Repeated rows are scanned alike.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import html.entities
import itertools
import lzma
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import columns, fresh, map_texts

KINDS = ("assign", "access", "hex")
#: Patterns and least lengths (fixed by the contract).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_VALUE = 8
# runs are taken whole, so a least length in the pattern equals matching runs and dropping short ones
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
#: Named entities of single ASCII characters; the patterns and all encodings consist of these.
ENTITIES = {name: char for name, char in html.entities.html5.items()
            if name.endswith(";") and len(char) == 1 and char.isascii()}
UNICODE_RUN = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
                         rf"|&#[0-9]{{1,7}};|&#[xX][0-9A-Fa-f]{{1,6}};|&(?:{'|'.join(ENTITIES)}))+")
UNICODE_ONE = re.compile(r"\\u\{?([0-9A-Fa-f]+)\}?|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);"
                         r"|&([A-Za-z]+;)")
#: The shortest match has 14 bytes (``token=`` and a value), in base64 19 characters without padding.
BASE64_LEAST = 19
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % BASE64_LEAST)
#: Between lines of a run: breaks, also as escapes, and blanks around them.  Or blanks alone, after ``WORD_LEAST`` characters.
LINE_GAP = re.compile(r"(?:[ \t]*(?:\r?\n|(?:\\r)?\\n))+[ \t]*")
WORD_GAP = re.compile(r"[ \t]+")
WORD_LEAST = 16
# possessive, and begun at the first character of a run only: time in proportion to the text
BASE64_LINES, BASE64_WORDS = (
    re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{least},}}+(?:{gap.pattern}[A-Za-z0-9+/_-]++)+")
    for least, gap in ((1, LINE_GAP), (WORD_LEAST, WORD_GAP)))
#: First bytes of compressed streams.
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
#: Every match and every further layer in decoded bytes has one of these.
PROMISING = re.compile(
    rb"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{32}|%[0-9A-Fa-f]{2}|\\[uUxrn]|&[#A-Za-z]|\n"
    rb"|[A-Za-z0-9+/_-]{" + str(WORD_LEAST).encode() + rb"}|" + MAGIC.pattern)
#: Bytes unpacked at a time, and how far the pieces of a longer layer overlap.
LAYER_BYTES = 1 << 20
OVERLAP = 4096
#: Bytes that an encoded run can consist of; pieces are not cut between two of them.
RUN_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\{}&#;.:\"'\r\n"


def matches(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of each match in ``text``."""
    out = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return out


class Layer:
    """Text, the source span of each character, and the decodings that led to it."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray, via: tuple[str, ...]):
        self.text, self.starts, self.ends, self.via = text, starts, ends, via

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


def _decoded(raw: bytes) -> tuple[str, np.ndarray, np.ndarray]:
    """``raw`` as text with the first and last byte of each character; a byte that is not UTF-8 is one character."""
    # surrogateescape keeps bytes and characters in step, then such a byte reads as Latin-1
    text = raw.decode("utf-8", "surrogateescape")
    if text.isascii():
        at = np.arange(len(raw))
        return text, at, at
    widths = np.array([1 if "\udc80" <= c <= "\udcff" else len(c.encode()) for c in text])
    last = np.cumsum(widths) - 1
    return re.sub("[\udc80-\udcff]", lambda m: chr(ord(m.group()) - 0xDC00), text), last - widths + 1, last


def _worker(head: bytes):
    """A decompressor for bytes that begin with ``head``; None if they aren't compressed."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(head) > 2 and head[0] == 0x78 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor()
    return None


def _unpacked(pieces: Iterable[bytes], whole: list | None = None) -> Iterator[bytes]:
    """Bytes of all members of a compressed stream, in pieces of bounded size; none if it isn't compressed.

    Where it ends well, the number of bytes after it in its last piece goes to ``whole``.
    """
    source = iter(pieces)
    data = next(source, b"")
    try:
        while worker := _worker(data):
            while True:
                out = worker.decompress(data, LAYER_BYTES)
                if out:
                    yield out
                if worker.eof:
                    break
                data = worker.unconsumed_tail if hasattr(worker, "unconsumed_tail") else b""
                # a piece may be read whole with output still to come
                if not data and len(out) < LAYER_BYTES and getattr(worker, "needs_input", True):
                    data = next(source, b"")
                    if not data:
                        return
            # members may be padded with zero bytes, and begin near the end of a piece
            data = worker.unused_data.lstrip(b"\0")
            while len(data) < 6 and (more := next(source, b"")):
                data = (data + more).lstrip(b"\0")
        if whole is not None:
            whole.append(len(data))
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
        return


def _whole_runs(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """``pieces`` cut only outside encoded runs, overlapping; an unfinished run is carried over."""
    tail, held, run = b"", [], 0  # `run`: held bytes at the end are one run
    for piece in pieces:
        held.append(piece)
        size = len(piece) - len(piece.rstrip(RUN_BYTES))
        if size == len(piece):
            run += size
            continue
        data = tail + b"".join(held)
        cut = len(data) - size
        yield data[:cut]
        tail = data[max(0, cut - OVERLAP):cut]
        held, run = [data[cut:]], size
    if run or (held and not tail):
        yield tail + b"".join(held)


def _from_bytes(raw: bytes, starts: np.ndarray, ends: np.ndarray, via: tuple[str, ...]) -> Iterator[Layer]:
    """Layers of decoded bytes, each byte with its source span."""
    if not raw:
        return
    text, first, last = _decoded(raw)
    yield Layer(text, starts[first], ends[last], via)
    for magic in MAGIC.finditer(raw):
        at, end, left = magic.start(), len(raw), []
        if not sum(map(len, _unpacked([raw[at:]], left))):
            continue
        if left:
            end -= left[0]
        yield from _from_stream(_unpacked([raw[at:end]]), int(starts[at:end].min()), int(ends[at:end].max()),
                                (*via, "compressed"))
        if left:  # what begins inside it is not a stream of its own
            break


def _from_stream(pieces: Iterator[bytes], low: int, high: int, via: tuple[str, ...]) -> Iterator[Layer]:
    """Layers of unpacked bytes, all from one source span."""
    head = b""
    for piece in pieces:  # a member may be as short as a byte
        head += piece
        if len(head) >= 6:
            break
    if not head:
        return
    first: list[bytes] = []

    def rest() -> Iterator[bytes]:
        yield head
        for piece in pieces:
            first.append(piece) if not seen else None
            yield piece

    seen = False
    for inner in _from_stream(_unpacked(rest()), low, high, (*via, "compressed")):
        seen = True
        first.clear()
        yield inner
    if seen:
        return
    for piece in _whole_runs(itertools.chain([head], first, pieces)):
        text, _, _ = _decoded(piece)
        yield Layer(text, np.full(len(text), low), np.full(len(text), high), via)


def _replaced(layer: Layer, runs: re.Pattern, decode, name: str) -> Layer | None:
    """The layer with every run decoded in place; None if none decodes."""
    texts, starts, ends = [], [], []
    at = 0
    for run in runs.finditer(layer.text):
        new = decode(run.group())
        if new is None:
            continue
        texts += [layer.text[at:run.start()], new[0]]
        starts += [layer.starts[at:run.start()], layer.starts[run.start() + new[1]]]
        ends += [layer.ends[at:run.start()], layer.ends[run.start() + new[2]]]
        at = run.end()
    if not texts:
        return None
    return Layer("".join([*texts, layer.text[at:]]), np.concatenate([*starts, layer.starts[at:]]),
                 np.concatenate([*ends, layer.ends[at:]]), (*layer.via, name))


def _chars(parts: list[tuple[str, int, int]]):
    return ("".join(c for c, _, _ in parts), np.array([s for _, s, _ in parts], int),
            np.array([e for _, _, e in parts], int))


def _url(run: str):
    """(text, first and last place in the run of each character) of a run of URL escapes."""
    text, first, last = _decoded(bytes.fromhex(run.replace("%", "")))
    return text, 3 * first, 3 * last + 2


def _unicode(run: str):
    """Likewise for a run of Unicode escapes; surrogate pairs and UTF-8 bytes are joined."""
    ones = list(UNICODE_ONE.finditer(run))
    if all(m.group(3) for m in ones):
        text, first, last = _decoded(bytes(int(m.group(3), 16) for m in ones))
        return (text, np.array([ones[i].start() for i in first], int),
                np.array([ones[i].end() - 1 for i in last], int))
    parts = []
    for m in ones:
        if m.group(6):
            code = ord(ENTITIES[m.group(6)])
        else:
            code = int(m.group(4)) if m.group(4) else int(m.group(1) or m.group(2) or m.group(3) or m.group(5), 16)
        if code > 0x10FFFF:
            code = 0xFFFD
        if 0xDC00 <= code < 0xE000 and parts and 0xD800 <= ord(parts[-1][0]) < 0xDC00:
            high, start, _ = parts.pop()
            code = 0x10000 + ((ord(high) - 0xD800) << 10) + code - 0xDC00
            parts.append((chr(code), start, m.end() - 1))
        else:
            parts.append((chr(code), m.start(), m.end() - 1))
    return _chars([("\ufffd" if 0xD800 <= ord(c) < 0xE000 else c, a, b) for c, a, b in parts])


def _wrapped(text: str, chains: re.Pattern, gap: re.Pattern) -> Iterator[list[tuple[int, int]]]:
    """Lines that may be one base64 run: several of equal width and a last one that is at most as wide.

    The line before them comes along: it may be the first of the run after other text, whatever its width.
    """
    for chain in chains.finditer(text):
        lines, start = [], chain.start()
        for end in gap.finditer(text, *chain.span()):
            lines.append((start, end.start()))
            start = end.end()
        lines.append((start, chain.end()))
        widths = [b - a for a, b in lines]
        at = 0
        while at < len(lines):
            end = _block(widths, at)
            full = gap is LINE_GAP or widths[at:at + 2] == [widths[at]] * 2
            if full and (end - at > 1 or at == 1):
                yield lines[max(0, at - 1):end]
            # the last line, if shorter, may be the first of the next block
            again = end < len(lines) and end - at > 1 and widths[end] <= widths[end - 1] < widths[at]
            at = end - 1 if again else end


def _block(widths: list[int], at: int) -> int:
    """End of the block of lines that begins at ``at``."""
    end = at + 1
    while end < len(widths) and widths[end] == widths[at]:
        end += 1
    return end + (end < len(widths) and widths[end] < widths[at])


def _base64(layer: Layer) -> Iterator[Layer]:
    text = layer.text
    runs = ([m.span()] for m in BASE64_RUN.finditer(text))
    for lines in itertools.chain(runs, _wrapped(text, BASE64_LINES, LINE_GAP), _wrapped(text, BASE64_WORDS, WORD_GAP)):
        whole = "".join(text[a:b] for a, b in lines).replace("-", "+").replace("_", "/")
        at = None
        for skipped in range(4):
            body = whole[skipped:]
            if len(body) % 4 == 1:
                body = body[:-1]
            if len(body) < BASE64_LEAST:
                break
            raw = base64.b64decode(body + "=" * (-len(body) % 4))
            if not PROMISING.search(raw):
                continue
            at = np.concatenate([np.arange(a, b) for a, b in lines]) if at is None else at
            bits = 8 * np.arange(len(raw))
            first, last = at[skipped + bits // 6], at[skipped + (bits + 7) // 6]
            yield from _from_bytes(raw, layer.starts[first], layer.ends[last], (*layer.via, "base64"))


def _bytes_in_escapes(layer: Layer) -> Iterator[Layer]:
    """Compressed bytes written as URL or ``\\x`` escapes."""
    for runs, width, name in ((URL_RUN, 3, "url"), (re.compile(r"(?:\\x[0-9A-Fa-f]{2})+"), 4, "unicode")):
        for run in runs.finditer(layer.text):
            raw = bytes.fromhex(re.sub(r"%|\\x", "", run.group()))
            if next(_unpacked([raw]), None) is not None:
                first = run.start() + np.arange(len(raw)) * width
                yield from _from_bytes(raw, layer.starts[first], layer.ends[first + width - 1], (*layer.via, name))


def unwrapped(layer: Layer) -> Iterator[Layer]:
    """Layers directly inside ``layer``."""
    if "%" in layer.text and (new := _replaced(layer, URL_RUN, _url, "url")):
        yield new
    if ("\\" in layer.text or "&" in layer.text) and (new := _replaced(layer, UNICODE_RUN, _unicode, "unicode")):
        yield new
    if "%" in layer.text or "\\x" in layer.text:
        yield from _bytes_in_escapes(layer)
    yield from _base64(layer)


def scan(text: str) -> list[dict]:
    """All secrets of ``text``, sorted by start, kind and end; ``via`` is empty for base spans."""
    base = matches(text)
    found = {(kind, a, b): () for kind, a, b in base}
    if "%" in text or "\\" in text or "&" in text or any(
            runs.search(text) for runs in (BASE64_RUN, BASE64_LINES, BASE64_WORDS)):
        places = np.arange(len(text) + 1)
        work = [Layer(text, places[:-1], places[1:], ())]
        seen = {(_digest(text), 0, len(text))}
        while work:
            for inner in unwrapped(work.pop()):
                mark = _digest(inner.text), int(inner.starts.min()), int(inner.ends.max())
                if mark in seen:
                    continue
                seen.add(mark)
                work.append(inner)
                for kind, a, b in matches(inner.text):
                    found.setdefault((kind, *inner.source(a, b)), inner.via)
    return [{"kind": KINDS[kind], "start": a, "end": b, "via": ">".join(via)}
            for (kind, a, b), via in sorted(found.items(), key=lambda x: (x[0][1], x[0][0], x[0][2]))]


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


SECRETS = "array<struct<kind: string, start: int, end: int, via: string>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("via", pa.string())]))


def find_secrets(docs: DataFrame, keep: list[str], text_col: str = "text", name: str = "secrets") -> DataFrame:
    """Columns ``keep`` of every row and ``name``: its secrets with kind, span and the decodings on the way."""

    def make():
        return lambda texts: [pa.array([scan(t) for t in texts], _TYPE)]

    return map_texts(docs, keep, text_col, make, f"{name} {SECRETS}")


def _listing(secrets: Column) -> Column:
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(found: DataFrame, id_col: str = "doc_id", name: str = "secrets") -> DataFrame:
    """Base counts and digest and all spans of the result of ``find_secrets``."""
    base = F.filter(name, lambda s: s["via"] == "")
    return found.withColumn("base", base).select(
        id_col,
        *(F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(_listing(F.col("base")), 256).alias("base_sha256"),
        _listing(F.col(name)).alias("spans"),
        (F.size(name) - F.size("base")).cast("long").alias("n_added"))


def masked(docs: DataFrame, text_col: str = "text", mask: str = "*") -> DataFrame:
    """``docs`` with every character of a secret replaced by ``mask``; lengths stay, null stays null."""
    (name,) = fresh(docs, "secrets")
    found = find_secrets(docs, docs.columns, text_col, name)
    text = F.aggregate(
        name, F.col(text_col),
        lambda text, s: F.overlay(text, F.repeat(F.lit(mask), s["end"] - s["start"]), s["start"] + 1))
    return found.withColumn(text_col, text).select(*columns(docs.columns))
