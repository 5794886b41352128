"""Repair of conversation structure by weighted interval parsing (operator 12).

The messages of a conversation, in order, are parsed with a grammar of edits.  The
role initials of a repaired conversation match ``(s?(ua)+)?``; as a grammar over its automaton's states
(0 nothing yet, 1 after ``s``, 2 after ``u``, 3 after ``a``) there is one nonterminal ``pq`` for
"leads from state p to state q", and the rules are in Chomsky normal form:

    pq -> pr rq                         a span is two spans
    pq -> message                       kept (0), given a role (2) or deleted (3)
    pq -> insertions message            insertion closure: each inserted message costs 2

A span's cell holds, for every nonterminal, the least (cost, audit); the audit is one letter an edit:
``D`` delete, ``I`` insert, ``K`` keep, ``R`` rerole.  Insertions belong to the message after them, those at the
very end to the conversation.  So audits of one span have as many other letters and none is the beginning
of another, which makes least cells of two halves the least of the whole, ties included.

The nonterminals are closed under any split: every split point of a span yields the same
cell.  The chart therefore needs one split for each span, and holds the spans of a binary
tree, bottom-up by length (1, 2, 4, ... messages): linear work where a general grammar needs the cube.
That also lets Spark parse a conversation in parts.  Messages are range-partitioned by conversation,
turn and text; each task parses the parts in its range, of at most ``PART_ROWS`` messages, and
a conversation joins its parts' cells, whose audits have been replaced by their order within the part.

Messages that equal each other in conversation, turn, role and text are one row with a
multiplicity up to the parse.  Of the text only a digest is shuffled for parsing.
One pass sorts the messages themselves by conversation and streams them past the audit; it holds
one message at a time (a digest of a conversation's text needs its messages in one order).

Edge cases: nulls in ``conv_id``, ``turn``, ``role`` and ``text``: a null id is a conversation of its own, null turns
come first, null role or text is one blank.  Messages of one turn are ordered by a digest of role and text, which makes
reruns agree.  Repeated rows are duplicates.  A conversation without messages has an empty audit.  Further
columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.session import ship_package, stage

WHITE = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Messages parsed as one part, at most.
PART_ROWS = 32_768

STATES = 4
LEGAL = {"su", "ua", "au"}
#: The role initial that leads from one state to another.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: Insertions that lead from a state to a later one, least first: the closure of inserted ``u`` and ``a``.
INSERTED = {(0, 0): 0, (0, 2): 1, (0, 3): 2, (1, 1): 0, (1, 2): 1, (1, 3): 2, (2, 2): 0, (2, 3): 1, (3, 3): 0, (3, 2): 1}
ENDS = (0, 3)

Cell = dict[tuple[int, int], tuple[int, str]]

MESSAGE = "conv_id bigint, ck string, turn bigint, role string, text string, copies int"


def messages(conversations: DataFrame) -> DataFrame:
    """The columns that count, nulls of role and text as one blank; ``ck`` is the id as text, never null."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), blank("conv_id").alias("ck"),
                                F.col("turn").cast("bigint").alias("turn"), blank("role").alias("role"),
                                blank("text").alias("text"), F.lit(1).alias("copies"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Messages as a hash of conversation and turn damages them: dropped, emptied, without their
    sentence ends, repeated, or given to the user."""
    rows = messages(conversations)
    kind = F.crc32(F.concat("ck", F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))) % 20
    rows = rows.withColumn("kind", kind).where("kind <> 0")
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    return rows.select("conv_id", "ck", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def _mark() -> Column:
    """What tells messages of one turn apart: a digest of role and text."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def _outline(rows: DataFrame) -> DataFrame:
    """A row per distinct message: what the parse needs to know of it, with its multiplicity and ``seen``,
    whether an earlier turn has the same role and text."""
    last = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    outline = rows.select(
        "ck", "turn", _mark().alias("mark"), F.substring("role", 1, 1).alias("initial"),
        F.when(last == "", "b").when(last.isin(".", "!", "?"), "").otherwise("t").alias("state"), "copies")
    outline = stage(outline.groupBy("ck", "turn", "mark", "initial", "state").agg(F.sum("copies").alias("copies")),
                    "outline")
    # blank messages are faulty anyway, so the hottest of all texts stays out of the join
    first = (outline.where("state <> 'b'").groupBy("ck", "mark").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns"))
             .where("turns > 1"))
    seen = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.struct("turn"))
    return outline.join(first, ["ck", "mark"], "left").select("ck", "turn", "mark", "initial", "state", "copies", seen.alias("seen"))


# the parse ----------------------------------------------------------------------


def message_cell(initial: str, must_go: bool, truncated: bool) -> Cell:
    """Least edits of one message, with insertions before it, between any two states."""
    cell: Cell = {}

    def offer(p: int, q: int, cost: int, audit: str) -> None:
        if (p, q) not in cell or (cost, audit) < cell[p, q]:
            cell[p, q] = (cost, audit)

    extra = TRUNCATED if truncated else 0
    for (p, r), n in INSERTED.items():
        cost, audit = INSERT * n, "I" * n
        offer(p, r, cost + DELETE, audit + "D")
        if not must_go:
            for role in "sua":
                q = STEPS.get((r, role))
                if q is not None:
                    if role == initial:
                        offer(p, q, cost + KEEP + extra, audit + "K")
                    if role != "s":
                        offer(p, q, cost + REROLE + extra, audit + "R")
    return cell


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjoining spans: over all states between them the least (cost, audit)."""
    out: Cell = {}
    for (p, r), (c1, a1) in left.items():
        for q in range(STATES):
            other = right.get((r, q))
            if other is not None:
                cost, best = c1 + other[0], out.get((p, q))
                if best is None or cost < best[0] or cost == best[0] and a1 + other[1] < best[1]:
                    out[p, q] = (cost, a1 + other[1])
    return out


def span_cell(cells: list[Cell]) -> Cell:
    """Bottom-up by span length: pairs of adjoining spans until one is left."""
    while len(cells) > 1:
        pairs = [combined(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = pairs + cells[2 * len(pairs):]
    return cells[0] if cells else {(p, p): (0, "") for p in range(STATES)}


def cheapest(cell: Cell) -> tuple[int, str]:
    """Cost and audit of a whole conversation: from nothing to a legal end, with insertions at its end."""
    found = []
    for r in range(STATES):
        for q in ENDS:
            if (0, r) in cell and (r, q) in INSERTED:
                n = INSERTED[r, q]
                found.append((cell[0, r][0] + INSERT * n, cell[0, r][1] + "I" * n))
    return min(found)


_CELLS: dict[tuple, Cell] = {}


def _cell_of(initial: str, must_go: bool, truncated: bool) -> Cell:
    key = ("" if initial not in ("s", "u", "a") or must_go else initial, must_go, truncated and not must_go)
    if key not in _CELLS:
        _CELLS[key] = message_cell(*key)
    return _CELLS[key]


PART = ("ck string, turn bigint, mark binary, n long, blank long, duplicate long, truncated long, illegal long, "
        "first string, last string, low bigint, last_turn bigint, turns long, froms array<int>, tos array<int>, costs array<long>, audits array<string>")


class _Part:
    """Messages of one conversation that follow each other, as they come in."""

    def __init__(self, ck: str, turn: int | None, mark: bytes) -> None:
        self.ck, self.turn, self.mark = ck, turn, mark
        self.cells: list[Cell] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first: str | None = None
        self.last = ""
        self.low: int | None = None
        self.last_turn: int | None = None

    def add(self, turn: int | None, initial: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        if self.first is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
        self.last, self.last_turn = initial, turn
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.cells.append(_cell_of(initial, blank or duplicate, truncated))

    def row(self) -> dict:
        cell = sorted(span_cell(self.cells).items())
        return {"ck": self.ck, "turn": self.turn, "mark": self.mark, "n": len(self.cells), "blank": self.blank,
                "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "first": self.first, "last": self.last, "low": self.low, "last_turn": self.last_turn, "turns": self.turns,
                "froms": [p for (p, _), _ in cell], "tos": [q for (_, q), _ in cell],
                "costs": [c for _, (c, _) in cell], "audits": [a for _, (_, a) in cell]}


def _parts(outline: Iterable[tuple], part_rows: int) -> Iterator[dict]:
    """Parts of sorted messages ``(ck, turn, mark, initial, state, copies, seen)``."""
    part: _Part | None = None
    for ck, turn, mark, initial, state, copies, seen in outline:
        for i in range(copies):
            if part is not None and (part.ck != ck or len(part.cells) >= part_rows):
                yield part.row()
                part = None
            if part is None:
                # a part that starts within a message's copies is placed after those before it
                part = _Part(ck, turn, mark + i.to_bytes(8, "big"))
            blank = state == "b"
            duplicate = not blank and (seen or i > 0)
            part.add(turn, initial, blank, duplicate, state == "t" and not duplicate)
    if part is not None:
        yield part.row()


def _batches(rows: Iterable[dict], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    some: list[dict] = []
    weight = 0
    for row in rows:
        some.append(row)
        weight += 1 + len(row.get("text") or "") // 500 + sum(map(len, row.get("audits") or ())) // 500
        if weight >= size:
            yield pa.RecordBatch.from_pylist(some, schema=schema)
            some, weight = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, schema=schema)


def _tuples(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


def parse(rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Parts of all conversations with their cells, stored; ``rows`` as ``messages`` returns them."""
    ship_package(rows.sparkSession)
    schema = _arrow(PART)
    order = ["ck", F.col("turn").asc_nulls_first(), "mark"]
    sorted_rows = (_outline(rows).select("ck", "turn", "mark", "initial", "state", "copies", "seen")
                   .repartitionByRange(*order).sortWithinPartitions(*order))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_parts(_tuples(batches), part_rows), schema)

    return stage(sorted_rows.mapInArrow(run, PART), "parts")


def _joined(parts: list[dict]) -> dict:
    """A conversation's numbers and audit from its parts, in order.

    While parts are joined, a part's audits are their ranks, as pieces of fixed width: audits of one part
    compare as their ranks do, and so do the sequences.
    """
    cells = []
    for part in parts:
        ranks = {a: f"{k:02d}" for k, a in enumerate(sorted(set(part["audits"])))}
        cells.append({(p, q): (c, ranks[a]) for p, q, c, a in
                      zip(part["froms"], part["tos"], part["costs"], part["audits"], strict=True)})
        part["by_rank"] = {r: a for a, r in ranks.items()}
    whole = span_cell(cells)
    cost, ranks = cheapest(whole)
    pieces = [part["by_rank"][ranks[2 * i:2 * i + 2]] for i, part in enumerate(parts)]
    borders = list(zip(parts, parts[1:], strict=False))
    turns = sum(p["turns"] for p in parts) - sum(
        a["last_turn"] is not None and a["last_turn"] == b["turn"] for a, b in borders)
    low = next((p["low"] for p in parts if p["low"] is not None), None)
    return {"audit": "".join(pieces) + ranks[2 * len(parts):], "cost": cost,
            "illegal": sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in LEGAL for a, b in borders),
            "gaps": 0 if low is None else parts[-1]["last_turn"] - low + 1 - turns,
            **{k: sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated")}}


# the messages past their audit ----------------------------------------------------


def _replayed(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """``(edit, role, text)`` for every letter of the audit, deleted messages included."""
    state, following = 0, iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(following)
        if edit in "IR":
            role = "assistant" if state == 2 else "user"
        if edit != "D":
            state = STEPS[state, role[:1]]
        yield edit, role, text


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, dict, Iterator[tuple[str, str, str]]]]:
    """Each conversation's id, numbers and replayed messages (to be read before the next conversation)."""
    from itertools import groupby

    for _, rows in groupby(_tuples(batches), key=lambda row: row[0]):
        conv_id, parts, ahead = None, [], []
        for row in rows:
            _, kind, turn, _, cid, role, text, copies, part = row
            if kind == 0:
                conv_id = cid
            elif kind == 1:
                parts.append({**part, "turn": turn})
            else:
                ahead = [(role, text, copies)]
                break

        def spoken(ahead: list = ahead, rows: Iterator[tuple] = rows) -> Iterator[tuple[str, str]]:
            for role, text, copies in ahead:
                yield from ((role, text) for _ in range(copies))
            for row in rows:
                yield from ((row[5], row[6]) for _ in range(row[7]))

        numbers = _joined(parts) if parts else dict.fromkeys(REPORT, 0) | {"audit": ""}
        yield conv_id, numbers, _replayed(numbers["audit"], spoken())


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _streamed(conversations: DataFrame, rows: DataFrame, part_rows: int) -> DataFrame:
    """Ids of all conversations, their parts and their messages, each conversation in one run and in this order."""
    parts = parse(rows, part_rows)
    ids = messages(conversations).select("ck", "conv_id").distinct()
    part = F.struct(*(c for c in parts.columns if c not in ("ck", "turn", "mark")))
    nothing = F.lit(None).cast(parts.select(part.alias("p")).schema["p"].dataType)
    null = lambda kind: F.lit(None).cast(kind)
    layout = lambda df, kind, **own: df.select("ck", F.lit(kind).alias("kind"), *(
        own.get(name, null(kind_)).alias(name) for name, kind_ in
        (("turn", "bigint"), ("mark", "binary"), ("conv_id", "bigint"), ("role", "string"), ("text", "string"), ("copies", "int"))),
        own.get("part", nothing).alias("part"))
    c = F.col
    union = (layout(ids, 0, conv_id=c("conv_id"))
             .unionByName(layout(parts, 1, turn=c("turn"), mark=c("mark"), part=part))
             .unionByName(layout(rows, 2, turn=c("turn"), mark=_mark(), role=c("role"), text=c("text"), copies=c("copies"))))
    return union.repartition("ck").sortWithinPartitions("ck", "kind", F.col("turn").asc_nulls_first(), "mark")


REPAIRED = "conv_id bigint, step bigint, edit string, role string, text string"


def repaired(conversations: DataFrame, rows: DataFrame | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """``(conv_id, step, edit, role, text)``: the edits of every conversation, in order; what is not deleted is the repair.

    ``rows``: the messages to repair, where they are not those of ``conversations`` as they are.
    """
    schema = _arrow(REPAIRED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(({"conv_id": conv_id, "step": i, "edit": edit, "role": role, "text": text}
                             for conv_id, _, edits in _conversations(batches)
                             for i, (edit, role, text) in enumerate(edits)), schema)

    rows = messages(conversations) if rows is None else rows
    return _streamed(conversations, rows, part_rows).mapInArrow(run, REPAIRED)


SUMMARY = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")


def _digest(edits: Iterable[tuple[str, str, str]]) -> str:
    sha, join = hashlib.sha256(), b""
    for edit, role, text in edits:
        if edit != "D":
            sha.update(join + f"{role}:{text}".encode())
            join = b"\n"
    return sha.hexdigest()


def summaries(conversations: DataFrame, rows: DataFrame | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Faults, cost and audit of every conversation, and a digest of its repaired messages."""
    schema = _arrow(SUMMARY)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(({"conv_id": conv_id, **{k: numbers[k] for k in REPORT}, "audit": numbers["audit"],
                              "repaired_sha256": _digest(edits)}
                             for conv_id, numbers, edits in _conversations(batches)), schema)

    rows = messages(conversations) if rows is None else rows
    return _streamed(conversations, rows, part_rows).mapInArrow(run, SUMMARY)
