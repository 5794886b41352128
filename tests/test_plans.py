"""Plan shapes that the design relies on at scale (checked on small inputs)."""

import os

from pyspark.sql import functions as F

from tabulon.functions import lenient_date
from tabulon.operators import profile, quality
from tabulon.operators.merge import upsert
from tabulon.sinks.tables import TableStore
from tabulon.sources.csv import read_csv_sources, scan_files
from tabulon.sources.files import file_inventory, with_row_identity

from core_helpers import local_dir


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_last_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"))
    p = plan(quality.keep_last(df, ["k"], ["pos"]))
    assert "WindowGroupLimit" in p and "Partial" in p
    partial_at = p.index("Partial")
    assert p.rfind("Exchange") < partial_at  # the partial limit sits below (before) the shuffle


def test_top_k_per_column_limits_before_shuffle(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).cast("string").alias("b"))
    for out in (profile.column_samples(df, ["a", "b"]), profile.extreme_lengths(df, ["a", "b"])):
        below = plan(out)[plan(out).rindex("Partial, "):] if "Partial, " in plan(out) else plan(out)[plan(out).rindex("Partial"):]
        assert "WindowGroupLimit" in plan(out)
        assert "Exchange" not in below, "nothing is shuffled before the first limit"
        assert plan(out).count("Range (") == 1, "one scan"


def test_date_parse_stays_in_codegen(spark):
    df = spark.range(10).select(F.lit("2008-01-28").alias("t"))
    p = plan(df.select(lenient_date("t")))
    assert "EvalPython" not in p  # no Python worker
    assert "*(" in p              # inside a whole-stage codegen stage


def test_profile_renders_no_numbers_as_text(spark):
    df = spark.range(10).select(F.col("id"), (F.col("id") * 1.5).alias("x"))
    assert "as string)" not in plan(profile.column_profile(df))


def test_file_table_is_broadcast(spark, scratch):
    d = local_dir(scratch)
    for i in range(3):
        with open(os.path.join(d, f"f{i}.csv"), "w") as fh:
            fh.write("a\n1\n")
    fs = scan_files(file_inventory(spark, scratch), scratch)
    assert "BroadcastHashJoin" in plan(read_csv_sources(spark, fs))


def test_bucketed_master_is_not_shuffled(spark, scratch):
    store = TableStore(spark, scratch + "/t")
    base = spark.range(0, 5000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    store.publish("m", base, bucket_keys=["k"], buckets=4)
    src = spark.range(0, 100).select(F.col("id").alias("k"), F.lit("w").alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(upsert(store.read("m"), src, ["k"], check=False, partitions=4))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in p
    assert not [op for op in ancestors(p, "Bucketed: true") if "Exchange" in op], p


def ancestors(tree: str, marker: str) -> list[str]:
    """Operators on the path from the root of a printed plan to the line with ``marker``."""
    lines = tree.splitlines()
    idx = next(i for i, ln in enumerate(lines) if marker in ln)

    def depth(ln: str) -> int:
        return len(ln) - len(ln.lstrip(" :+-"))

    path, level = [], depth(lines[idx])
    for ln in reversed(lines[:idx]):
        if depth(ln) < level:
            path.append(ln.strip(" :+-"))
            level = depth(ln)
    return path


def test_hot_key_third_of_rows(spark):
    """One key holds a third of all rows: results stay exact."""
    import pandas as pd

    n = 3000
    data = [(0 if i % 3 == 0 else i, i) for i in range(n)]
    df = spark.createDataFrame(data, "k bigint, pos bigint")
    pdf = pd.DataFrame(data, columns=["k", "pos"])
    got = sorted(r.pos for r in quality.keep_last(df, ["k"], ["pos"]).collect())
    assert got == sorted(pdf[~pdf.duplicated("k", keep="last")]["pos"])
    dups = quality.duplicate_rows(df, ["k"], ["pos"]).count()
    assert dups == int(pdf.duplicated("k", keep="last").sum()) == n // 3 - 1
    s = quality.uniqueness_summary(df, ["k"]).first()
    assert (s.n_duplicate_keys, s.n_excess_rows) == (1, n // 3 - 1)


def test_top_k_per_column_equals_python_with_a_hot_value(spark):
    rows = [("a" * (1 + i % 40) + str(i % 90), None if i % 5 == 0 else "hot" if i % 3 else f"v{i}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(6)
    values = {c: {r[i] for r in rows if r[i] is not None} for i, c in enumerate("ab")}
    got = {(r.column_name, r["rank"]): r.value for r in profile.column_samples(df, k=7).collect()}
    assert got == {(c, n): v for c in "ab" for n, v in enumerate(sorted(values[c])[:7], 1)}
    ends = {(r.column_name, r.end, r["rank"]): (r.value, r.length) for r in profile.extreme_lengths(df, ["a", "b"], 7).collect()}
    want = {}
    for c in "ab":
        for end, sign in (("shortest", 1), ("longest", -1)):
            for n, v in enumerate(sorted(values[c], key=lambda v: (sign * len(v), v))[:7], 1):
                want[c, end, n] = (v, len(v))
    assert ends == want


def test_duplicates_by_identity_move_whole_rows_once(spark, scratch):
    """No copy is written first, and the winners are a narrow aggregate that is combined before its shuffle."""
    rows = [(i % 5, i % 50, f"payload {i % 50}") for i in range(500)] + [(None, 1, "x")] * 3
    spark.createDataFrame(rows, "k int, pos int, payload string").repartition(4).write.parquet(scratch)
    df, identity = with_row_identity(spark.read.parquet(scratch))
    out = quality.duplicate_rows(df, ["k"], ["pos"], identity)
    p = plan(out)
    assert out.columns == ["k", "pos", "payload"]
    assert p.count("Exchange hashpartitioning") <= 4 and "numbered-" not in p
    winners = p[p.index("partial_max"):] if "partial_max" in p else ""
    assert winners and "payload" not in winners.split("FileScan")[1].split("ReadSchema")[1]
    assert out.count() == len(rows) - 6
    flagged = quality.flag_duplicates(df, ["k"], ["pos"], identity=identity)
    assert flagged.columns == ["k", "pos", "payload", "is_duplicate"]
    assert flagged.where("not is_duplicate").count() == 6


def test_top_k_candidates_are_found_without_sorting_all_rows(spark):
    """What is sorted is what a task's batches left over, a few rows for each column and end."""
    rows = [("a" * (1 + i % 70) + str(i), None if i % 7 == 0 else f"ö{i % 500}") for i in range(5_000)]
    df = spark.createDataFrame(rows, "a string, `b.c` string").repartition(3)
    orders = [[("length", by), ("value", "ascending")] for by in ("ascending", "descending")]
    left = profile._candidates(df, ["a", "b.c"], 4, orders)
    assert left.count() <= 3 * 2 * 2 * 4
    found = {(r.column_name, r.value) for r in left.collect()}
    for c, i in (("a", 0), ("b.c", 1)):
        values = {r[i] for r in rows if r[i] is not None}
        for sign in (1, -1):
            want = sorted(values, key=lambda v: (sign * len(v), v.encode()))[:4]
            assert {(c, v) for v in want} <= found
    p = plan(profile.extreme_lengths(df, ["a", "b.c"], 4))
    assert p.rindex("MapInArrow") > p.rindex("Sort ["), "nothing is sorted below the candidates"
