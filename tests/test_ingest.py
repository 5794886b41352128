import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from tabulon.operators.merge import upsert
from tabulon.operators.quality import GateFailed
from tabulon.plans.ingest import ingest, pending_files, prepare, resume
from tabulon.schema import TableSpec
from tabulon.sinks.tables import TableStore

from core_helpers import local_dir

SPEC = TableSpec("ing", StructType([StructField("ID", LongType(), False),
                                    StructField("NAME", StringType()),
                                    StructField("START", DateType())]), ("ID",))


def write(d, name, text):
    path = os.path.join(d, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


FILES = {
    "FY2001.csv": "ID,NAME,START\n1,a,2001-01-05\n2,b,1/6/2001\n3,c,\n",
    "FY2002.csv": "NAME,ID,START,EXTRA\nbb,2,2002-02-02,z\ndd,4,3012-01-01,z\n",
    "FY2003.csv": "START,ID,NAME\n03/03/2003,1,aaa\n,5,\"e, \"\"quoted\"\"\"\n",
}


def test_consolidated_equals_sequential(spark, scratch):
    d = local_dir(scratch)
    for name, text in FILES.items():
        write(d, name, text)
    prep = prepare(spark, scratch, SPEC)
    got = sorted(tuple(r) for r in prep.rows.collect())
    # sequential: one merge per file, in name order
    seq = spark.createDataFrame([], SPEC.schema)
    for name in sorted(FILES):
        one = local_dir(f"{scratch}-one-{name}")
        write(one, name, FILES[name])
        seq = upsert(seq, prepare(spark, f"{scratch}-one-{name}", SPEC).rows, ["ID"])
    assert got == sorted(tuple(r) for r in seq.collect())
    import datetime as dt
    assert dict((r[0], (r[1], r[2])) for r in got) == {
        1: ("aaa", dt.date(2003, 3, 3)), 2: ("bb", dt.date(2002, 2, 2)), 3: ("c", None),
        4: ("dd", None), 5: ('e, "quoted"', None)}
    assert [tuple(r) for r in prep.extras.select("source", "extra_column").collect()] == [("FY2002.csv", "EXTRA")]
    assert prep.metrics["rows"] == 7


def test_duplicate_in_file_fails_or_keeps_last(spark, scratch):
    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START\n1,x,\n1,y,\n")
    with pytest.raises(GateFailed):
        prepare(spark, scratch, SPEC)
    rows = prepare(spark, scratch, SPEC, on_duplicate="keep_last").rows.collect()
    assert [(r.ID, r.NAME) for r in rows] == [(1, "y")]


def test_key_is_cast_before_uniqueness(spark, scratch):
    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START\n7,x,\n007,y,\n")
    with pytest.raises(GateFailed):
        prepare(spark, scratch, SPEC)


def test_null_key_and_long_date_fail(spark, scratch):
    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START\n,x,\n")
    with pytest.raises(GateFailed):
        prepare(spark, scratch, SPEC)
    d2 = local_dir(scratch + "-b")
    write(d2, "a.csv", "ID,NAME,START\n1,x,2008-01-28 00:00\n")
    with pytest.raises(GateFailed):
        prepare(spark, scratch + "-b", SPEC)


def test_dry_run_still_gates(spark, scratch):
    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START\n1,x,2008-01-28 00:00\n")
    with pytest.raises(GateFailed):
        prepare(spark, scratch, SPEC)


def test_strict_columns(spark, scratch):
    from tabulon.operators.conform import SchemaMismatch

    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START,MORE\n1,x,,m\n")
    with pytest.raises(SchemaMismatch):
        prepare(spark, scratch, SPEC, conform_mode="strict")
    d2 = local_dir(scratch + "-m")
    write(d2, "a.csv", "ID,NAME\n1,x\n")
    with pytest.raises(SchemaMismatch):
        prepare(spark, scratch + "-m", SPEC)


def test_resume_equals_full_run(spark, scratch):
    d = local_dir(scratch + "/in")
    for name, text in FILES.items():
        write(d, name, text)
    full = TableStore(spark, scratch + "/full", register=False)
    ingest(full, SPEC, scratch + "/in")
    part = TableStore(spark, scratch + "/part", register=False)
    from tabulon.sources.files import file_inventory
    first = file_inventory(spark, scratch + "/in").where(F.col("file_name") < "FY2003")
    ingest(part, SPEC, scratch + "/in", files=first)
    assert pending_files(part, SPEC, scratch + "/in").count() == 1
    resume(part, SPEC, scratch + "/in")
    assert pending_files(part, SPEC, scratch + "/in").count() == 0
    assert sorted(map(tuple, part.read("ing").collect())) == sorted(map(tuple, full.read("ing").collect()))
    # a second resume with nothing new publishes nothing
    before = part.current_version("ing")
    assert resume(part, SPEC, scratch + "/in") == before


def test_watermark_lists_new_files_only_and_a_full_listing_finds_late_ones(spark, scratch):
    from datetime import timedelta

    from tabulon.plans.ingest import watermark
    from tabulon.sources.files import file_inventory

    d = local_dir(scratch + "/in")
    noon = 1_700_000_000

    def deliver(name, rows, at):
        write(d, name, "ID,NAME,START\n" + rows)
        os.utime(os.path.join(d, name), (at, at))

    deliver("a.csv", "1,a,\n", noon)
    deliver("b.csv", "2,b,\n", noon + 3600)
    store = TableStore(spark, scratch + "/t", register=False)
    day = timedelta(days=1)
    assert watermark(store, SPEC, day) is None
    assert pending_files(store, SPEC, scratch + "/in", lookback=day).count() == 2  # no ledger yet: all files
    resume(store, SPEC, scratch + "/in", lookback=day)
    assert watermark(store, SPEC, day).timestamp() == noon + 3600 - 86400
    deliver("c.csv", "3,c,\n", noon + 7200)
    deliver("late.csv", "4,late,\n", noon - 3 * 86400)       # older than the watermark
    deliver("a.csv", "1,corrected,\n", noon + 10)            # again, within the lookback
    new = pending_files(store, SPEC, scratch + "/in", lookback=day)
    assert sorted(r.file_name for r in new.collect()) == ["a.csv", "c.csv"]
    # files before the watermark are in no plan
    listed = file_inventory(spark, scratch + "/in", modified_after=watermark(store, SPEC, timedelta(minutes=30)))
    assert sorted(os.path.basename(f) for f in listed.inputFiles()) == ["b.csv", "c.csv"]
    resume(store, SPEC, scratch + "/in", lookback=day)
    assert pending_files(store, SPEC, scratch + "/in", lookback=day).isEmpty()
    assert [r.file_name for r in pending_files(store, SPEC, scratch + "/in").collect()] == ["late.csv"]
    resume(store, SPEC, scratch + "/in")
    assert sorted((r.ID, r.NAME) for r in store.read("ing").collect()) == [
        (1, "corrected"), (2, "b"), (3, "c"), (4, "late")]


def test_ledger_records_only_files_read(spark, scratch):
    d = local_dir(scratch + "/in")
    write(d, "FY2001.csv", FILES["FY2001.csv"])
    store = TableStore(spark, scratch + "/t", register=False)
    from tabulon.sources.files import file_inventory
    files = file_inventory(spark, scratch + "/in")
    prep_files = files.collect()  # what is there now
    write(d, "FY2002.csv", FILES["FY2002.csv"])  # arrives before the ledger is written
    ingest(store, SPEC, scratch + "/in", files=spark.createDataFrame(prep_files, files.schema))
    assert [r.file_name for r in store.ledger("ing").collect()] == ["FY2001.csv"]
    assert [r.file_name for r in pending_files(store, SPEC, scratch + "/in").collect()] == ["FY2002.csv"]


def _staging_dirs(spark):
    import re

    from tabulon.session import checkpoint_root

    base = re.sub(r"^file:/*", "/", checkpoint_root(spark)) + "/tabulon"
    return {n for n in os.listdir(base) if n.startswith("ingest-stage-")} if os.path.isdir(base) else set()


def test_staged_input_removed_after_ingest_and_failed_gate(spark, scratch):
    d = local_dir(scratch + "/in")
    for name, text in FILES.items():
        write(d, name, text)
    before = _staging_dirs(spark)
    store = TableStore(spark, scratch + "/store", register=False)
    ingest(store, SPEC, scratch + "/in")
    assert store.read("ing").count() == 5
    assert _staging_dirs(spark) == before
    bad = local_dir(scratch + "/bad")
    write(bad, "a.csv", "ID,NAME,START\n1,x,\n1,y,\n")
    with pytest.raises(GateFailed):
        prepare(spark, scratch + "/bad", SPEC)
    assert _staging_dirs(spark) == before
    kept = prepare(spark, scratch + "/in", SPEC)   # a caller of prepare owns its staging
    assert kept.staging and _staging_dirs(spark) - before


def test_key_repeated_across_part_files_of_an_extract_fails(spark, scratch):
    d = local_dir(scratch)
    write(d, "FY=2001/part-0.csv", "ID,NAME,START\n1,x,\n")
    write(d, "FY=2001/part-1.csv", "ID,NAME,START\n1,y,\n2,z,\n")
    write(d, "FY=2002/part-0.csv", "ID,NAME,START\n1,other year,\n")
    with pytest.raises(GateFailed, match="not unique"):
        prepare(spark, scratch, SPEC)


def test_redelivered_file_is_read_again(spark, scratch):
    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START\n1,a,\n")
    write(d, "b.csv", "ID,NAME,START\n5,b,\n")
    store = TableStore(spark, register=False)
    ingest(store, SPEC, scratch)
    write(d, "a.csv", "ID,NAME,START\n1,corrected,\n2,new,\n")
    assert [r.file_name for r in pending_files(store, SPEC, scratch).collect()] == ["a.csv"]
    resume(store, SPEC, scratch)
    assert sorted((r.ID, r.NAME) for r in store.read("ing").collect()) == [(1, "corrected"), (2, "new"), (5, "b")]
    assert pending_files(store, SPEC, scratch).isEmpty()


def test_ingest_keeps_the_bucketing_of_the_master(spark, scratch):
    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START\n1,a,\n")
    store = TableStore(spark, register=False)
    store.create_if_absent("ing", SPEC.schema, ["ID"], bucket_keys=["ID"], buckets=4)
    ingest(store, SPEC, scratch)
    assert store.bucketing("ing") == (["ID"], 4)


def test_malformed_records_are_counted_and_can_abort(spark, scratch):
    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START\n1\n2,b,2001-01-01,EXTRA\n3,c,20010101\n")
    prep = prepare(spark, scratch, SPEC)
    assert prep.metrics["malformed"] == 2
    assert prep.metrics["no_separator_START"] == 1
    assert dict((r.column_name, r.rejects) for r in prep.reject_report(spark).collect())["START"] == 1
    with pytest.raises(GateFailed, match="fields"):
        prepare(spark, scratch, SPEC, on_malformed="fail")


def test_line_breaks_abort_a_single_line_read(spark, scratch):
    d = local_dir(scratch)
    write(d, "a.csv", 'ID,NAME,START\n1,"two\nlines",\n')
    assert prepare(spark, scratch, SPEC).rows.count() == 1
    with pytest.raises(GateFailed):
        prepare(spark, scratch, SPEC, multi_line=False, on_duplicate="keep_last")


def test_empty_files_are_reported(spark, scratch):
    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START\n1,a,\n")
    write(d, "sub/none.csv", "")
    prep = prepare(spark, scratch, SPEC)
    assert prep.empty == ["sub/none.csv"] and prep.metrics["empty_files"] == 1
    assert prep.rows.count() == 1


def test_upsert_plan_ranks_once(spark, scratch):
    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START\n1,a,\n2,b,\n")
    prep = prepare(spark, scratch, SPEC)
    target = spark.createDataFrame([], SPEC.schema)
    merged = upsert(target, prep.rows, ["ID"], check=False, key_side=prep.typed.select("ID").distinct())
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    # the ranking window has given way to the aggregate of the staged keys, see test_prepare_ranks_by_one_aggregate
    assert plan.count("row_number()") == 0 and plan.count("Window [") == 0
    assert "csv" not in plan.lower()


def test_prepare_ranks_by_one_aggregate(spark, scratch):
    """Gates, keys and winners come from one stored aggregate; rows move only if a key occurs twice, and by their place."""
    d = local_dir(scratch)
    write(d, "a.csv", "ID,NAME,START\n1,a,\n2,b,\n")
    once = prepare(spark, scratch, SPEC)
    assert "Join" not in once.rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in once.keys._jdf.queryExecution().optimizedPlan().toString()
    write(d, "b.csv", "ID,NAME,START\n2,c,\n3,d,\n")
    twice = prepare(spark, scratch, SPEC)
    plan = twice.rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 1 and "Window" not in plan and "Aggregate" not in plan
    assert sorted((r.ID, r.NAME) for r in twice.rows.collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(r.ID for r in twice.keys.collect()) == [1, 2, 3]


def test_rejected_texts_are_kept_per_file(spark, scratch):
    d = local_dir(scratch)
    for name, text in (("a.csv", "ID,D,V\n1,x,1\n2,2020-01-01,y\n3,x,z\n4,,\n"), ("b.csv", "ID,D,V\n5,2020-13-40,7\n")):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    from pyspark.sql.types import DateType, DoubleType, LongType, StructField, StructType
    from tabulon.schema import TableSpec

    spec = TableSpec("r", StructType([StructField("ID", LongType(), False), StructField("D", DateType()),
                                      StructField("V", DoubleType())]), ("ID",))
    prep = prepare(spark, scratch, spec)
    got = sorted((r._file, r.column_name, r.text, r.n, r["rank"]) for r in prep.reject_sample().collect())
    assert got == [("a.csv", "D", "x", 2, 1), ("a.csv", "V", "y", 1, 1), ("a.csv", "V", "z", 1, 2), ("b.csv", "D", "2020-13-40", 1, 1)]
    assert {(r._file, r.text) for r in prep.reject_sample(1).collect()} == {("a.csv", "x"), ("a.csv", "y"), ("b.csv", "2020-13-40")}


def test_keys_are_counted_by_hash_and_places_looked_up_for_repeated_ones(spark, scratch):
    """Keys of one row need neither their place nor their extracts; winners are the same few or many keys repeat."""
    from pyspark.sql import functions as F

    from tabulon.plans.ingest import _per_key

    def places(rows, name):
        df = spark.createDataFrame(rows, "k int, _source string, _seq int, _block long, _row long").repartition(3)
        keys, repeated, found = _per_key(df, F.col("k").isNotNull(), ["k"], f"{scratch}/{name}")
        assert sorted(r.k for r in keys.collect()) == sorted({r[0] for r in rows if r[0] is not None})
        if found is None:
            return repeated, None
        kept = df.where("k is not null").join(found[0], ["_seq", "_block", "_row"], found[1])
        return repeated, sorted(tuple(r) for r in kept.select("k", "_source", "_seq", "_block", "_row").collect())

    single = [(i, "a", 0, 0, i) for i in range(50)] + [(None, "a", 0, 0, 60)] * 2
    assert places(single, "single") == (0, None)
    last = lambda rows: sorted({r[0]: r for r in sorted(rows, key=lambda r: r[2:]) if r[0] is not None}.values())
    across = single + [(3, "b", 1, 0, 0), (4, "b", 1, 0, 1)]
    assert places(across, "across") == (0, last(across))
    within = across + [(5, "b", 1, 7, 0), (5, "b", 1, 7, 1)]
    assert places(within, "within") == (1, last(within))
    many = [(i % 5, "ab"[i % 2], i % 2, 0, i) for i in range(40)]
    assert places(many, "many") == (5, last(many))
