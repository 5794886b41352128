"""Multi-line CSV files read in many splits give what one task per file gives."""

import os
import random

import pytest

from tabulon.plans.registry import one_file_csv
from tabulon.sources.csv import read_csv_sources, row_positions, scan_files
from tabulon.sources.files import file_inventory
from tabulon.sources.split_csv import read_csv_split, split_records, unpaired_quotes

from core_helpers import SF_SMALL, local_dir


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def both(spark, root):
    files = scan_files(file_inventory(spark, root), root)
    return read_csv_split(spark, files), read_csv_sources(spark, files)


def as_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def odd_csv(rng, n, eol="\n"):
    """Records with doubled quotes, separators and line breaks; some far longer than a split."""
    def field():
        text = "".join(rng.choices(['""', ",", eol, "word ", "é", ""], k=rng.randrange(0, 9)))
        if rng.random() < 0.02:
            text += ("long " + eol) * 3_000
        return f'"{text}"' if text or rng.random() < 0.3 else ""
    return "".join(f"{i},{field()},{field()}{eol}" for i in range(n))


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_splits_give_the_records_of_whole_files(spark, scratch, small_splits, eol):
    d = local_dir(scratch)
    rng = random.Random(4)
    for name, head in (("a.csv", "id,x,y"), ("b.csv", "y,id,x y"), ("c.csv", "id,x,y")):
        with open(os.path.join(d, name), "w", newline="") as fh:
            fh.write(head + eol + odd_csv(rng, 150, eol))
    split, whole = both(spark, scratch)
    columns = ["id", "x", "y", "x y", "_file", "_seq", "_corrupt_record"]
    assert as_rows(split, *columns) == as_rows(whole, *columns)
    assert split.select("_seq", "_block").distinct().count() > 10
    ordered = lambda df: as_rows(row_positions(df), "_file", "row_pos", "id", "x")
    assert ordered(split) == ordered(whole)


def test_one_file_is_read_by_many_tasks(spark, small_splits):
    root = one_file_csv(spark, SF_SMALL)
    files = scan_files(file_inventory(spark, root), root)
    assert len(files.files) == 1
    records = split_records(spark, [files.files[0]["path"]])
    assert records.select("block").distinct().count() > 20
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = read_csv_split(spark, files)
    assert as_rows(got, "doc_id", "text") == sorted(((str(r.doc_id), r.text or None) for r in docs.collect()), key=repr)


def test_a_text_with_unpaired_quotes_is_refused(spark, scratch):
    d = local_dir(scratch)
    with open(os.path.join(d, "bad.csv"), "w") as fh:
        fh.write('k,v\n1,"open\n2,x\n')
    with open(os.path.join(d, "good.csv"), "w") as fh:
        fh.write('k,v\n1,"a ""b"" c"\n')
    files = scan_files(file_inventory(spark, scratch), scratch)
    assert [r.path_key.rsplit("/", 1)[1] for r in unpaired_quotes(spark, [f["path"] for f in files.files]).collect()] == ["bad.csv"]
    with pytest.raises(ValueError, match="bad.csv"):
        read_csv_split(spark, files)


def test_blank_lines_missing_fields_and_files_without_records(spark, scratch, small_splits):
    d = local_dir(scratch)
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write('k,v\n\n1,x\n\n2\n3,"y\n\nz"\n4,a,b')
    with open(os.path.join(d, "b.csv"), "w") as fh:
        fh.write("k,v\n")
    split, whole = both(spark, scratch)
    assert as_rows(split, "k", "v", "_corrupt_record") == as_rows(whole, "k", "v", "_corrupt_record")


def test_prepare_reads_in_splits(spark, scratch, small_splits):
    from tabulon.plans.ingest import prepare
    from tabulon.plans.registry import yearly_orders
    from tabulon.schema import ORDERS

    root = yearly_orders(spark, SF_SMALL)
    assert as_rows(prepare(spark, root, ORDERS, multi_line="split").rows, *ORDERS.names) == \
        as_rows(prepare(spark, root, ORDERS).rows, *ORDERS.names)


def test_large_extracts_are_written_in_parts(spark, scratch):
    """No task writes, or reads as one file, more than a part's text; a small table is one file."""
    from tabulon.plans.fixtures import in_large_parts

    spark.range(4_000, numPartitions=8).selectExpr("id", "repeat(cast(id % 10 as string), 100) as text").write.parquet(scratch)
    df = spark.read.parquet(scratch)
    assert in_large_parts(df).rdd.getNumPartitions() == 1
    parts = in_large_parts(df, 108_000)
    assert parts.rdd.getNumPartitions() == 4
    assert as_rows(parts, "id", "text") == as_rows(df, "id", "text")
    assert in_large_parts(df.where("id < 0")).count() == 0
