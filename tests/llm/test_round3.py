"""Operators 11 to 13: SQL, brute force, parts of long conversations, hot sources and edge rows."""

import functools
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import tabulon.llm.conversations as conversations
from llm_helpers import edge_table, empty_table
from tabulon.llm import collocations, mixing, queries

SF = "/root/testdata/sf0.001"


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def duck_rows(rows, sql, names, columns):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents ({names})")
    if rows:
        con.executemany(f"INSERT INTO documents VALUES ({', '.join('?' * len(rows[0]))})", rows)
    rel = con.sql(sql)
    at = [rel.columns.index(c) for c in columns]
    return sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


# mixing -------------------------------------------------------------------------

MIX = ["doc_id", "source", "size", "source_size", "target", "taken", "copies"]


def docs_with_sources(seed, n=400):
    rng = random.Random(seed)
    sources = ["a", "b", "B", "é", "", None, "z"]
    return [(i, " ".join(["w"] * rng.choice([0, 1, 7, 30])) if i % 17 else None,
             "a" if i % 3 == 0 else sources[min(6, int(rng.expovariate(0.6)))]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_equals_sql_with_a_hot_source(spark, seed):
    rows = docs_with_sources(seed)
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    assert rows_of(got, MIX) == duck_rows(rows, mixing.oracle_sql(), "doc_id BIGINT, text VARCHAR, source VARCHAR", MIX)


def test_mix_keeps_to_its_targets(spark):
    got = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    taken, size, target, largest = Counter(), {}, {}, Counter()
    for r in got:
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[r.source] += r.taken
        size[r.source], target[r.source] = r.source_size, r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    weights = dict(zip(sorted(size), [1, 2, 3] * len(size), strict=False))
    level = {target[s] / weights[s] for s in size if target[s] < 3 * size[s]}
    assert max(level) == pytest.approx(min(level)), "sources that are not full share by weight"
    for s in size:
        assert target[s] <= 3 * size[s]
        assert abs(taken[s] - target[s]) <= 2 * largest[s] + 0.1 * target[s]
    assert sum(taken.values()) <= sum(size.values())


def test_mix_is_the_same_again_in_other_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(mixing.mix(docs), MIX) == rows_of(mixing.mix(docs.repartition(7)), MIX)


def test_mix_on_edge_rows(spark):
    got = mixing.mix(edge_table(spark)).collect()
    assert len(got) == edge_table(spark).count()
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert rows_of(mixing.mix(empty_table(spark)), MIX) == []
    blank = spark.createDataFrame([(1, None, "s"), (2, " \t", None)], "doc_id bigint, text string, source string")
    assert rows_of(mixing.mix(blank), ["doc_id", "target", "taken"]) == [(1, 0.0, 0), (2, 0.0, 0)]


# conversations ------------------------------------------------------------------

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def cheapest_edits(rows):
    """Least (cost, audit) by states from the right; rows are (initial, must go, truncated)."""

    @functools.cache
    def best(i, state, inserted):
        options = [(0, "")] if i == len(rows) and state in (0, 3) else []
        if inserted < 3:
            for role in "ua":
                if (state, role) in NEXT:
                    c, a = best(i, NEXT[state, role], inserted + 1)
                    options.append((c + 2, "I" + a))
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            c, a = best(i + 1, state, 0)
            options.append((c + 3, "D" + a))
            if not must_go:
                for role in "sua":
                    if (state, role) in NEXT:
                        c, a = best(i + 1, NEXT[state, role], 0)
                        if role == initial:
                            options.append((c + truncated, "K" + a))
                        if role != "s":
                            options.append((c + 2 + truncated, "R" + a))
        return min(options, default=(10**9, ""))

    for i in range(len(rows), 0, -50):  # from the right, so that the recursion stays flat
        for state in range(4):
            best(i, state, 0)
    return best(0, 0, 0)


def brute_conversation(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of damaged rows (turn, role, text), in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        ink = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, audit = cheapest_edits(tuple((r, f in ("blank", "duplicate"), f == "truncated") for r, f in zip(initials, faults, strict=True)))
    out, state, at = [], 0, 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at][1:]
        at += edit != "I"
        if edit in "IR":
            role = "assistant" if state == 2 else "user"
        if edit != "D":
            out.append(f"{role}:{text}")
            state = NEXT[state, role[:1]]
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute_damage(table):
    kept = defaultdict(list)
    for conv_id, turn, role, text in table:
        kept[conv_id]  # every id has a result
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept[conv_id] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    mark = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, mark(r))) for c, rows in kept.items()}


SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check_query(spark, table, got):
    want = {c: brute_conversation(rows) for c, rows in brute_damage(table).items()}
    found = {r.conv_id: tuple(r[c] for c in SUMMARY) for r in got.collect()}
    assert found == want


def test_repair_equals_brute_force_on_the_whole_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    check_query(spark, table, queries.op12_conversation_repair(spark, SF))


def odd_conversations(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", None, "Yes. ", "end. ", "Ä"]
    roles = ["user", "assistant", "system", "User", "", None, "tool"]
    table = [(c, rng.choice([None, *range(8)]), rng.choices(roles, [9, 9, 3, 1, 1, 1, 1])[0], rng.choice(texts))
             for c in [None, *range(60)] for _ in range(rng.randrange(1, 14))]
    return table + table[:40]


@pytest.mark.parametrize("part_rows", [1, 3, 32_768])
def test_repair_of_odd_rows_in_parts_of_any_length(spark, part_rows):
    table = odd_conversations(part_rows)
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(table)],
                               "conv_id bigint, turn bigint, role string, text string, ck int")
    check_query(spark, table, conversations.summaries(df, conversations.damaged(df), part_rows))


def test_chart_of_all_spans_and_splits_gives_the_same_cell():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randrange(1, 9))]
        cells = {(i, i + 1): conversations.message_cell(*row) for i, row in enumerate(rows)}
        for length in range(2, len(rows) + 1):
            for i in range(len(rows) - length + 1):
                options = [conversations.combined(cells[i, k], cells[k, i + length]) for k in range(i + 1, i + length)]
                assert all(o == options[0] for o in options), "any split gives the least cell"
                cells[i, i + length] = options[0]
        assert conversations.cheapest(cells[0, len(rows)]) == cheapest_edits(tuple(rows))


def test_a_long_conversation_is_parsed_in_many_parts(spark):
    rng = random.Random(9)
    table = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["One.", "two", f"Text {t}."])) for t in range(700)]
    table += [(c, 0, "user", "Hi.") for c in range(100, 200)]
    df = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string")
    assert conversations.parse(conversations.messages(df), 64).where("ck = '7'").count() >= 700 // 64
    check_query(spark, table, conversations.summaries(df, conversations.damaged(df), 64))


def test_repaired_messages_follow_the_grammar(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    out = defaultdict(str)
    for r in sorted(conversations.repaired(df).where("edit <> 'D'").collect(), key=lambda r: (r.conv_id, r.step)):
        out[r.conv_id] += r.role[:1]
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in out.values())


def test_repair_of_an_empty_table(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert conversations.summaries(df, conversations.damaged(df)).collect() == []


# collocations -------------------------------------------------------------------

BEST = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute_phrases(rows, least, most=3):
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, most + 1):
                counts.update((lang or "und", " ".join(words[i:i + m])) for i in range(len(words) - m + 1))
    return {k: v for k, v in counts.items() if v >= least}, n


def phrase_rows(seed):
    rng = random.Random(seed)
    words = ["New", "york", "the", "a", "of", "é", "x y", " ", "don't", "city"]
    out = [(" ".join(rng.choices(words, [6, 6, 9, 9, 3, 2, 1, 1, 1, 2], k=rng.randrange(0, 40))).replace(" of ", rng.choice([" of ", ", of\t", "\n", "!?"])),
            rng.choice(["en", "de", None, "und"])) for _ in range(150)]
    return out + [("hot passage of words that repeats itself", "en")] * 200 + [(None, "en"), ("", None), ("\n\r \t", "de")]


@pytest.mark.parametrize("batch,bucket", [(8 << 20, 1 << 20), (300, 50)])
def test_phrase_counts_equal_brute_force_in_any_batches(spark, batch, bucket):
    rows = phrase_rows(batch)
    df = spark.createDataFrame([(t, k, 1) for t, k in rows], "text string, lang string, phrase int")
    want, n = brute_phrases(rows, 4)
    got = collocations.phrase_counts(df, 3, 4, batch, bucket)
    assert {(r.lang, r.phrase): r.occurrences for r in got.where("size > 0").collect()} == want
    totals = Counter()
    for r in got.where("size = 0").collect():
        totals[r.lang] += r.occurrences
    assert totals == +n


def test_texts_longer_than_a_batch_are_cut_between_words():
    rng = random.Random(3)
    text = "".join(rng.choice(["ab", "c", "d" * 90]) + rng.choice([" ", "  ", "\t", ". ", "\n"]) for _ in range(3_000))
    want, _ = brute_phrases([(text, "en")], 2)
    for size in (40, 64, 1_000):
        counts = Counter()
        for words, follow in collocations._slices(text.encode().translate(collocations._TABLE), 3, size):
            dictionary, windows, _ = collocations._windows(words, follow, 3)
            for w in windows.tolist():
                for m in range(1, 4):
                    if w[m - 1] >= 0:
                        counts["en", b" ".join(dictionary[i] for i in w[:m]).decode()] += 1
        assert {k: v for k, v in counts.items() if v >= 2} == want


def test_a_batch_is_held_as_numbers_and_packed_bucket_by_bucket():
    """Words of a batch are not held as objects, nor all its buckets at once: memory stays near that of the numbers."""
    import tracemalloc

    import pyarrow as pa

    words = [f"word{i:05d}" for i in range(4_000)]
    rng = random.Random(8)
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(500)]  # 2 MB of text, 200,000 words
    batches = (pa.RecordBatch.from_pydict({"lang": ["en"] * 100, "text": texts[at:at + 100]}) for at in range(0, 500, 100))
    tracemalloc.start()
    try:
        rows = 0
        for out in collocations._batches(batches, 3, 64, 8 << 20):
            assert out.nbytes < 4 * collocations.SENT_BYTES
            rows += out.num_rows
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 64
    assert peak < 24e6, peak


def test_sorted_suffixes_are_counted_as_a_dictionary_would():
    rng = np.random.default_rng(1)
    for n, k, least in [(0, 3, 1), (1, 3, 1), (500, 2, 1), (3_000, 9, 10), (3_000, 400, 3)]:
        suffixes = rng.integers(0, k, (n, 3)).astype(np.int32)
        suffixes[rng.random(n) < 0.2, 1:] = -1
        suffixes[rng.random(n) < 0.2, 2] = -1
        sizes = rng.integers(1, 4, n)
        want = Counter()
        for row, s in zip(suffixes.tolist(), sizes.tolist(), strict=True):
            for m in range(1, 4):
                if row[m - 1] >= 0:
                    want[tuple(row[:m])] += s
        got = {tuple(suffixes[h][:size].tolist()): c for size, heads, counts in collocations.sort_suffixes(suffixes, sizes, least)
               for h, c in zip(heads.tolist(), counts.tolist(), strict=True)}
        assert got == {p: c for p, c in want.items() if c >= least}


def test_best_phrases_equal_sql(spark):
    rows = phrase_rows(11)
    df = spark.createDataFrame(rows, "text string, lang string")
    for covered in (50, 101):
        got = rows_of(collocations.collocations(df, least=5, top=12, covered=covered), BEST)
        assert got == duck_rows(rows, collocations.oracle_sql(5, 12, covered), "text VARCHAR, lang VARCHAR", BEST)


def test_scores_of_large_counts_are_exact(spark, monkeypatch):
    big = 3_000_000_000
    counted = spark.createDataFrame([("en", 1, "p", big), ("en", 1, "q", big - 1), ("en", 2, "p q", big - 2), ("en", 0, "", 9 * big)],
                                    "lang string, size int, phrase string, occurrences bigint")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: counted)
    [row] = collocations.collocations(None).collect()
    assert row.score == 1_000_000 * (big - 2) ** 2 // (big * (big - 1))


def test_phrases_of_edge_tables(spark):
    assert collocations.collocations(empty_table(spark)).collect() == []
    got = collocations.collocations(edge_table(spark), least=2)
    assert got.columns == BEST and got.count() > 0
