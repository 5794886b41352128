import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon.operators import quality


def test_uniqueness_summary_counts_null_as_value(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k bigint")
    r = quality.uniqueness_summary(df, ["k"]).first()
    assert (r.n_rows, r.n_keys, r.n_duplicate_keys, r.n_excess_rows, r.is_unique) == (5, 3, 2, 2, False)


def test_assert_unique(spark):
    with pytest.raises(quality.GateFailed):
        quality.assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])
    quality.assert_unique(spark.createDataFrame([(1,), (2,)], "k int"), ["k"])


def test_keep_last_matches_pandas(spark):
    import random

    rnd = random.Random(3)
    data = [(rnd.choice([1, 2, 3, None]), i, rnd.random()) for i in range(300)]
    pdf = pd.DataFrame(data, columns=["k", "pos", "v"])
    want = pdf[~pdf.duplicated("k", keep="last")]
    df = spark.createDataFrame(data, "k bigint, pos int, v double")
    got = quality.keep_last(df, ["k"], ["pos"]).toPandas()
    assert sorted(got["pos"]) == sorted(want["pos"])
    dups = quality.duplicate_rows(df, ["k"], ["pos"]).toPandas()
    assert sorted(dups["pos"]) == sorted(pdf[pdf.duplicated("k", keep="last")]["pos"])
    flagged = quality.flag_duplicates(df, ["k"], ["pos"]).toPandas()
    assert int(flagged["is_duplicate"].sum()) == int(pdf.duplicated("k", keep="last").sum())


def test_keep_last_sql_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4)], "k bigint, pos int")
    got = sorted(r.pos for r in quality.keep_last(df, ["k"], ["pos"], nulls_equal=False).collect())
    assert got == [1, 2, 4]


def test_length_gate_null_column_passes(spark):
    df = spark.createDataFrame([("2008-01-28", None), ("1/2/2008", None)], "a string, b string")
    got = {r.column_name: (r.value, r.passed) for r in quality.length_gate(df, ["a", "b"]).collect()}
    assert got == {"a": (10, True), "b": (None, True)}
    too_long = spark.createDataFrame([("2008-01-28 00:00",)], "a string")
    with pytest.raises(quality.GateFailed):
        quality.assert_gates(quality.length_gate(too_long, ["a"]))


def test_gate_rows(spark):
    df = spark.createDataFrame([(1, "2008-01-28"), (1, "2008-01-29")], "k bigint, d string")
    got = {r.gate: (r.value, r.passed) for r in quality.gate_rows(df, ["k"], ["k", "d"], ["d"], "t").collect()}
    assert got == {"key_unique": (1, False), "non_empty": (2, True), "column_set": (0, True),
                   "date_text_length": (10, True)}


def test_drop_duplicates_count(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k bigint, v string")
    assert quality.drop_duplicates(df, ["k"]).count() == 3


def test_column_profile_brute_force(spark):
    import datetime as dt

    from tabulon.operators import profile

    rows = [(1, "ab", 1.5, dt.date(2020, 1, 1)), (1, None, -0.0, None), (None, "abcd", 0.0, dt.date(2020, 1, 1)),
            (3, "ab", None, dt.date(2021, 1, 1))]
    df = spark.createDataFrame(rows, "a bigint, s string, x double, d date")
    got = {r.column_name: tuple(r)[1:] for r in profile.column_profile(df).collect()}
    assert got == {"a": (4, 1, 2, None, None), "s": (4, 1, 2, 2, 4),
                   "x": (4, 1, 2, None, None), "d": (4, 1, 2, None, None)}


def test_length_histograms(spark):
    a = spark.createDataFrame([("ab",), ("abc",), ("abc",)], "t string")
    b = spark.createDataFrame([("ab",), ("abc",), (None,)], "t string")
    got = sorted(tuple(r) for r in quality.length_histograms(a, b, "t").collect() if r.length is not None)
    assert got == [(2, 1, 1, False), (3, 2, 1, True)]


def test_exact_duplicates_are_all_but_one(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, "n"), (None, "n"), (3, "z")],
                               "k int, v string")
    assert sorted(map(tuple, quality.duplicate_rows(df, ["k"], ["v"]).collect()), key=repr) == \
        sorted([(1, "a"), (1, "a"), (None, "n")], key=repr)
    assert quality.duplicate_rows(df, ["k"]).count() == 3  # by position
    flagged = quality.flag_duplicates(df, ["k"], ["v"], "dup")
    assert flagged.where("dup").count() == 3 and flagged.columns == ["k", "v", "dup"]


def test_profile_counts_instants_not_wall_times(spark):
    from tabulon.operators import profile

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # the hour that daylight saving repeats
        df = spark.createDataFrame([(1699162200,), (1699165800,)], "s long").selectExpr("timestamp_seconds(s) AS t")
        assert profile.column_profile(df).first()["n_distinct"] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_content_fingerprints_tell_multisets_apart(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, "b"), (3, "", "c")]
    ddl = "k int, x string, y string"
    left = spark.createDataFrame(rows, ddl)
    for other, equal in ((rows[::-1], True), (rows[1:], False), ([*rows, rows[0]], False), ([*rows[:2], (2, "b", None), rows[3]], False),
                         ([*rows[:3], (3, None, "c")], False)):
        right = spark.createDataFrame(other, ddl).repartition(3)
        got = quality.same_content(left.withColumn("g", F.lit("g")), right.withColumn("g", F.lit("g")), ["k", "x", "y"], ["g"])
        assert [r.equal for r in got.collect()] == [equal], other
    halves = quality.same_content(left.withColumn("g", F.col("k")), left.where("k < 3").withColumn("g", F.col("k")), ["k", "x", "y"], ["g"])
    assert sorted((r.g, r.n_left, r.n_right, r.equal) for r in halves.collect()) == [(1, 2, 2, True), (2, 1, 1, True), (3, 1, 0, False)]


def test_united_sketches_are_those_of_all_rows(spark):
    from tabulon.operators import sketches

    df = spark.range(60_000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 20_011).alias("n"),
                                    F.concat(F.lit("v"), (F.col("id") % 977).cast("string")).alias("t"),
                                    F.lit(None).cast("double").alias("e"), (F.col("id") % 5).alias("file"))
    exact = ["column_name", "n_rows", "n_nulls", "min_value", "max_value", "min_length", "max_length"]
    fresh = sketches.profile(sketches.sketch(df, ["n", "t", "e"]))
    united = sketches.profile(sketches.unite(sketches.sketch(df, ["n", "t", "e"], by=["file"])))
    a, b = ({r.column_name: r for r in x.collect()} for x in (fresh, united))
    assert {c: [a[c][k] for k in exact] for c in a} == {c: [b[c][k] for k in exact] for c in b}
    for r in (a, b):
        assert abs(r["n"].n_distinct_estimate - 20_011) < 0.03 * 20_011 and abs(r["t"].n_distinct_estimate - 977) < 0.03 * 977
        assert abs(r["n"].median - 10_000) < 400 and r["e"].median is None and r["e"].n_distinct_estimate == 0
    assert sketches.profile(sketches.unite(sketches.sketch(df.limit(0), ["n"], by=["file"]))).collect() == []
