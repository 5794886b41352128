from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tabulon.functions.casts import lenient_double, lenient_long
from tabulon.operators.conform import SchemaMismatch, conform


def test_long_rule(spark):
    rows = [("7",), ("007",), ("3.0",), ("3.00",), ("-4.0",), ("3.5",), ("x1",), ("",), (None,), (" 12 ",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.v for r in df.select(lenient_long("t").alias("v")).collect()]
    assert got == [7, 7, 3, 3, -4, None, None, None, None, 12]


def test_double_rule(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("n/a",), ("1.2345678E7",), (None,)], "t string")
    got = [r.v for r in df.select(lenient_double("t").alias("v")).collect()]
    assert got == [1.5, None, None, 12345678.0, None]


def test_conform_orders_names_and_counts_rejects(spark):
    from pyspark.sql import Observation

    schema = StructType([StructField("ID", LongType(), False), StructField("n", IntegerType()),
                         StructField("s", StringType())])
    df = spark.createDataFrame([("a", "1", "x", "e"), (None, "2.0", "5", "e")], "s string, id string, N string, more string")
    obs = Observation("r")
    out = conform(df, schema, observation=obs)
    rows = out.collect()
    assert out.columns == ["ID", "n", "s"]
    assert [(r.ID, r.n, r.s) for r in rows] == [(1, None, "a"), (2, 5, None)]
    assert obs.get["rejects_n"] == 1


def test_conform_strict_and_missing(spark):
    import pytest

    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string")
    with pytest.raises(SchemaMismatch):
        conform(df, schema, mode="strict")
    with pytest.raises(SchemaMismatch):
        conform(df.select("a"), schema)


def test_conform_fail_on_cast_error(spark):
    import pytest

    schema = StructType([StructField("a", LongType())])
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="cannot convert"):
        conform(df, schema, on_cast_error="fail").collect()


def test_ntz_text_is_zone_free(spark):
    import datetime as dt

    from tabulon.functions.casts import ntz_text

    rows = [(dt.datetime(2024, 3, 10, 2, 30, 0, 120000),), (dt.datetime(2024, 1, 1, 0, 0, 7),), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r.t for r in df.select(ntz_text("ts").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2024-03-10 02:30:00.120000", "2024-01-01 00:00:07.000000", None]
