import os

from pyspark.sql import functions as F

from tabulon.operators.conform import extra_columns
from tabulon.sources.csv import (SOURCE, header_groups, read_csv_inferred, read_csv_sources, read_csv_text,
                                 row_positions, scan_files, write_csv)
from tabulon.sources.files import file_inventory

from core_helpers import local_dir

QUOTED = 'id,a,b\n1,"say ""hi"", so ",x\n2,"line one\nline two",\n3,,"z"\n'


def test_quote_aware_read(spark, scratch):
    d = local_dir(scratch)
    with open(os.path.join(d, "f.csv"), "w") as fh:
        fh.write(QUOTED)
    got = [tuple(r) for r in read_csv_text(spark, scratch).orderBy("id").collect()]
    assert got == [("1", 'say "hi", so ', "x"), ("2", "line one\nline two", None), ("3", None, "z")]
    assert read_csv_text(spark, scratch).schema.simpleString() == "struct<id:string,a:string,b:string>"


def test_write_read_identity(spark, scratch):
    src = spark.createDataFrame([(1, 'a "q", b'), (2, "multi\nline, text"), (3, None), (4, "")],
                                "id int, t string")
    write_csv(src, scratch)
    back = read_csv_text(spark, scratch).select(F.col("id").cast("int"), "t")
    # an empty field reads as NULL under the quote-aware reader options
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == \
        [(1, 'a "q", b'), (2, "multi\nline, text"), (3, None), (4, None)]


def test_header_drift_is_mapped_by_name(spark, scratch):
    d = local_dir(scratch)
    os.makedirs(os.path.join(d, "FY1"), exist_ok=True)
    os.makedirs(os.path.join(d, "FY2"), exist_ok=True)
    with open(os.path.join(d, "FY1", "a.csv"), "w") as fh:
        fh.write("k,v\n1,a\n2,b\n")
    with open(os.path.join(d, "FY2", "a.csv"), "w") as fh:
        fh.write("v,extra,K\nc,e,3\nd,e,4\n")
    inv = file_inventory(spark, scratch)
    headers, groups = header_groups(inv)
    assert len(groups) == 2
    df = read_csv_sources(spark, scan_files(inv, scratch))
    got = sorted((r["k"], r["v"], r[SOURCE]) for r in df.collect())
    assert got == [("1", "a", "FY1"), ("2", "b", "FY1"), ("3", "c", "FY2"), ("4", "d", "FY2")]
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])
    extras = [tuple(r) for r in extra_columns(headers, schema).select("source", "extra_column").collect()]
    assert extras == [("FY2", "extra")]


def test_row_positions_follow_file_order(spark, scratch):
    d = local_dir(scratch)
    os.makedirs(os.path.join(d, "S"), exist_ok=True)
    for name, start in (("p0.csv", 0), ("p1.csv", 100)):
        with open(os.path.join(d, "S", name), "w") as fh:
            fh.write("n\n" + "".join(f"{start + i}\n" for i in range(50)))
    inv = file_inventory(spark, scratch)
    df = row_positions(read_csv_sources(spark, scan_files(inv, scratch)))
    got = sorted((int(r["n"]), r["row_pos"]) for r in df.collect())
    assert got == [(i, i + 1) for i in range(50)] + [(100 + i, 51 + i) for i in range(50)]


def test_paths_with_spaces(spark, scratch):
    d = local_dir(scratch + "/a dir")
    os.makedirs(os.path.join(d, "FY 1"), exist_ok=True)
    with open(os.path.join(d, "FY 1", "x y.csv"), "w") as fh:
        fh.write("n\n1\n2\n")
    inv = file_inventory(spark, scratch + "/a dir")
    assert [(r.source, r.file_name) for r in inv.collect()] == [("FY 1", "FY 1/x y.csv")]
    df = read_csv_sources(spark, scan_files(inv, scratch + "/a dir"))
    assert sorted((r["n"], r["_source"], r["_file"], r["_seq"]) for r in df.collect()) == \
        [("1", "FY 1", "FY 1/x y.csv", 0), ("2", "FY 1", "FY 1/x y.csv", 0)]


def test_inventory_skips_hidden(spark, scratch):
    d = local_dir(scratch)
    for name in ("a.csv", ".hidden.csv", "_tmp.csv"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("x\n1\n")
    assert [r.file_name for r in file_inventory(spark, scratch).collect()] == ["a.csv"]


def test_split_reads_keep_row_order(spark, scratch):
    """A large single-line file read in many splits keeps its row order."""
    d = local_dir(scratch)
    os.makedirs(os.path.join(d, "S"), exist_ok=True)
    with open(os.path.join(d, "S", "big.csv"), "w") as fh:
        fh.write("n,pad\n" + "".join(f"{i},{'x' * 40}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        fs = scan_files(file_inventory(spark, scratch), scratch)
        df = read_csv_sources(spark, fs, multiLine="false")
        assert df.select("_block").distinct().count() > 5
        got = sorted((int(r["n"]), r["row_pos"]) for r in row_positions(df).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i, i + 1) for i in range(20000)]


def test_crlf_and_bom(spark, scratch):
    d = local_dir(scratch)
    with open(os.path.join(d, "w.csv"), "wb") as fh:
        fh.write("﻿id,name\r\n1,\"a\r\nb\"\r\n2,c\r\n".encode("utf-8"))
    inv = file_inventory(spark, scratch)
    fs = scan_files(inv, scratch)
    assert fs.files[0]["header"] == ["id", "name"]
    rows = sorted((r["id"], r["name"]) for r in read_csv_sources(spark, fs).collect())
    # the quote-aware reader turns a CRLF inside a quoted field into LF
    assert rows == [("1", "a\nb"), ("2", "c")]


def test_inferred_types_over_drifting_headers(spark, scratch):
    d = local_dir(scratch)
    for name, text in (("a.csv", "k,v,d,t,e,f\n3,1,2020-02-29,2020-01-01 10:00,,true\n"),
                       ("b.csv", "v,K,d,x,f\n1.5,4,2020-03-01,01/02/2020,FALSE\n")):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    df = read_csv_inferred(spark, scratch)
    assert dict(df.dtypes) == {"k": "bigint", "v": "double", "d": "date", "t": "timestamp_ntz", "e": "string",
                               "f": "boolean", "x": "string"}
    assert sorted((r.k, r.v, str(r.d), r.x, r.f) for r in df.collect()) == \
        [(3, 1.0, "2020-02-29", None, True), (4, 1.5, "2020-03-01", "01/02/2020", False)]


def test_inference_widens_for_the_odd_value(spark):
    from tabulon.functions.inference import inferred_types

    df = spark.createDataFrame([("1", "1", "2020-01-01", "9" * 19, "1e5", None, "1"),
                                ("2", "x", "2020-02-30", "1", "-.5", None, "NaN")],
                               "a string, b string, c string, d string, e string, f string, `g.h` string")
    assert inferred_types(df) == {"a": "bigint", "b": "string", "c": "string", "d": "double", "e": "double",
                                  "f": "string", "g.h": "string"}
    assert inferred_types(df.limit(0)) == dict.fromkeys(df.columns, "string")
