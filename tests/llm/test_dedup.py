"""Operators 2, 3, 4 and 7: SQL, brute force, skew and edge rows."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import tabulon.llm.exact_dedup as exact_dedup
import tabulon.llm.simhash as simhash
from llm_helpers import EDGE_SCHEMA, components, edge_rows, edge_table, empty_table, fingerprint, small_table
from tabulon.llm import line_dedup, queries, sharding

SF = "/root/testdata/sf0.001"


def duck(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return con.sql(sql)


def same(got, want):
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    rows = [tuple(r[c] for c in order) for r in got.collect()]
    where = [want.columns.index(c) for c in order]
    assert sorted(rows, key=repr) == sorted((tuple(r[i] for i in where) for r in want.fetchall()), key=repr)


# sharding ---------------------------------------------------------------------


@pytest.mark.parametrize("limit", [200, 2_000, 30_000, 10**9])
def test_shards_equal_sql(spark, limit):
    rng = random.Random(limit)
    rows = [(i, "x" * rng.choice([0, 5, 50, 700])) for i in range(400)] + [(400, None), (401, "y" * 5_000)]
    same(sharding.assign_shards(small_table(spark, rows), limit), duck(rows, sharding.oracle_sql(limit)))


def test_shards_of_one_id_still_fit(spark):
    rows = [(7, "x" * 99)] * 300 + [(8, "")] * 200 + [(i, "z" * 40) for i in range(100)]
    got = sharding.assign_shards(small_table(spark, rows), 1_000).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.n_bytes + 1
    assert max(sizes.values()) <= 1_000
    assert all(sizes[r.shard] == r.shard_bytes for r in got)
    names = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False)), "shards are disjoint prefixes"


def test_shards_on_edge_rows(spark, scratch):
    got = sharding.assign_shards(edge_table(spark), 100_000)
    assert sorted((r.doc_id, r.n_bytes) for r in got.filter("doc_id is not null").collect()) == \
        sorted((r[0], len((r[1] or "").encode())) for r in edge_rows() if r[0] is not None)
    assert got.count() == len(edge_rows())
    assert sharding.assign_shards(empty_table(spark), 100).count() == 0
    docs = small_table(spark, [(i, "x" * 50) for i in range(60)])
    sharding.write_shards(docs, f"{scratch}/a", 500)
    assert spark.read.parquet(f"{scratch}/a").count() == 60


def test_written_shards_hold_every_row_once(spark, scratch):
    """Null ids and one id on many rows as well; all columns come along."""
    docs = edge_table(spark).unionByName(edge_table(spark).where("doc_id = 9"))
    report = sharding.write_shards(docs, scratch, 300)
    back = spark.read.parquet(scratch)
    assert back.count() == docs.count()
    assert sorted(map(repr, back.select("doc_id", "text", "`a.b`").collect())) == \
        sorted(map(repr, docs.select("doc_id", "text", "`a.b`").collect()))
    rows = {r.shard: (r.n_rows, r.shard_bytes) for r in report.collect()}
    sizes = Counter()
    for r in back.collect():
        sizes[r.shard] += len((r.text or "").encode()) + 1
    assert sizes == {s: size for s, (_, size) in rows.items()}
    assert all(size <= 300 or n == 1 for n, size in rows.values())


# line dedup -------------------------------------------------------------------


def line_rows(n, seed):
    rng = random.Random(seed)
    common = [f"common line number {i}" for i in range(12)]
    long_line = " ".join(f"w{i}" for i in range(60))
    rows = []
    for i in range(n):
        lines = [rng.choice([*common, "", "  ", long_line, f"own {i} {rng.random()}"]) for _ in range(rng.randint(0, 9))]
        rows.append((i, "\n".join(lines)))
    return [*rows, (n, None), (n + 1, "a\na\na\na\na"), (n + 2, "\n\n\n")]


@pytest.mark.parametrize("run_lines", [2, 3])
def test_line_runs_equal_sql(spark, run_lines):
    rows = line_rows(150, run_lines)
    same(line_dedup.deduplicate_lines(small_table(spark, rows), run_lines), duck(rows, line_dedup.oracle_sql(run_lines)))


def test_line_runs_of_one_frequent_block(spark):
    block = "first shared line\nsecond shared line"
    rows = [(i, f"own {i}\n{block}\nend {i}") for i in range(300)]
    got = {r.doc_id: r for r in line_dedup.deduplicate_lines(small_table(spark, rows)).collect()}
    assert got[0].n_deleted == 0 and got[0].text == rows[0][1]
    assert all(got[i].deleted_runs == "1-2" and got[i].text == f"own {i}\nend {i}" for i in range(1, 300))


def test_lines_on_edge_rows(spark):
    got = line_dedup.deduplicate_lines(edge_table(spark)).collect()
    assert len(got) == len(edge_rows())
    assert sum(r.text is None for r in got) == 2  # null texts stay
    assert sum(r.n_deleted == 1 and r.text == "last line " for r in got) == 1  # a copied long line goes
    assert line_dedup.deduplicate_lines(empty_table(spark)).count() == 0


# simhash -----------------------------------------------------------------------


@pytest.mark.parametrize(("n", "group_rows", "budget"), [(500, 16_000, 2), (500, 40, 2), (300, 20, 1), (300, 30, 3)])
def test_trie_join_equals_all_pairs(spark, monkeypatch, n, group_rows, budget):
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)  # small groups: split in Spark, again and again
    rng = random.Random(n + budget)
    marks = [0, 2**64 - 1, 1, 3]
    while len(marks) < n:
        marks.append(rng.getrandbits(64) if rng.random() < 0.5 else
                     rng.choice(marks) ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 1, 2, 3]))))
    rows = [(int(np.uint64(f).astype(np.int64)), i) for i, f in enumerate(marks)]
    got = {r.f: r.component for r in simhash.near_duplicates(
        spark.createDataFrame(rows, "f bigint, i bigint"), "f", "i", budget).collect()}
    label = components(set(marks), lambda a, b: (a ^ b).bit_count() <= budget)
    least = defaultdict(lambda: n)
    for i, f in enumerate(marks):
        least[label[f]] = min(i, least[label[f]])
    assert got == {int(np.uint64(f).astype(np.int64)): least[label[f]] for f in marks}


def test_simhash_query_equals_brute_force(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in
           queries.QUERIES["op4_simhash_near_dedup"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    marks = {i: fingerprint(t) for i, t in texts.items()}
    label = components(set(marks), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 2)
    assert got == {i: (f"{marks[i]:016x}", label[i]) for i in texts}


def test_simhash_on_edge_rows(spark):
    got = simhash.simhash_components(edge_table(spark))
    marks = Counter(r.fingerprint for r in got.collect())
    assert marks == Counter(f"{fingerprint(r[1]):016x}" for r in edge_rows())
    empty = got.filter("fingerprint = '0000000000000000'").collect()
    assert {r.component_id for r in empty} == {3} and len(empty) == 4  # no words: linked like any other
    assert simhash.simhash_components(empty_table(spark)).count() == 0
    kept = simhash.first_of_near_duplicates(edge_table(spark))
    assert kept.columns == edge_table(spark).columns
    groups = {(r.component_id, r.fingerprint if r.component_id in (9, None) else "") for r in got.collect()}
    assert kept.count() == len(groups)  # two texts share id 9


# exact dedup --------------------------------------------------------------------


def exact_rows():
    rng = random.Random(9)
    rows = [(i, rng.choice(["a b", "ab", "a  b ", "abc", "", " ", "x\ty", "xy"]) + "!" * rng.randint(0, 3))
            for i in range(300)]
    return [*rows, (300, None), (301, "only once")]


def test_duplicates_equal_sql(spark):
    same(exact_dedup.duplicates(small_table(spark, exact_rows()), capacity=4, max_depth=3),
         duck(exact_rows(), queries.ORACLE_SQL["op7_exact_dedup"]))


def test_colliding_addresses_are_told_apart_by_bytes(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = exact_rows()
    want = duck(rows, queries.ORACLE_SQL["op7_exact_dedup"])
    plain = {(r[0], r[1], r[2], r[3]) for r in want.fetchall()}
    monkeypatch.setattr(exact_dedup, "_address", lambda text: F.length(text).cast("long"))
    monkeypatch.setattr(exact_dedup, "_chain", lambda text: F.lit("same"))
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in
           exact_dedup.duplicates(small_table(spark, rows)).collect()}
    assert got == plain


def test_directory_splits_only_overfull_buckets():
    assert exact_dedup.directory([1, 1, 1, 1], 10) == [0, 0, 0, 0]
    assert exact_dedup.directory([9, 9, 1, 1], 10) == [0, 1, 2, 2]
    assert exact_dedup.directory([50, 0, 0, 0], 10) == [0, 1, 2, 2]  # one cell may stay overfull


def test_duplicates_on_edge_rows(spark):
    got = exact_dedup.duplicates(edge_table(spark)).collect()
    groups = defaultdict(list)
    for i, t in [(r[0], r[1] or "") for r in edge_rows()]:
        groups["".join(t.split())].append((-len(t), i is None, i))
    assert Counter(r.group_size for r in got) == Counter(len(g) for g in groups.values() for _ in g)
    assert sum(r.kept for r in got) == len(groups)  # one of a repeated row stays
    assert {(r.keep_id) for r in got if r.kept} == {min(g, key=repr)[2] if len(g) == 1 else sorted(
        g, key=lambda x: (x[0], x[1], x[2] or 0))[0][2] for g in groups.values()}
    assert exact_dedup.duplicates(empty_table(spark)).count() == 0
    kept = exact_dedup.first_of_equals(edge_table(spark))
    assert kept.columns == edge_table(spark).columns and kept.count() == len(groups)
    assert kept.schema.simpleString() == spark.createDataFrame([], EDGE_SCHEMA).schema.simpleString()
