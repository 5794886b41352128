"""Upsert: typed empty target, update and insert, the merge that must fail, nulls, narrowing."""

import pytest
from pyspark.sql import functions as F

from tabulon.operators.merge import MergeCardinalityError, cardinality_violations, upsert
from tabulon.sources.literals import literal_frame

NAMES = ["city_id", "city", "visits"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def target(spark):
    return literal_frame(spark, [], "a SMALLINT NOT NULL, b STRING, c DOUBLE", NAMES)


@pytest.fixture()
def january(spark):
    return literal_frame(spark, [(10, "Oslo", 1.5), (20, "Lima", 2.5), (30, "Pune", 3.5)], None, NAMES)


@pytest.fixture()
def february(spark):
    return literal_frame(spark, [(20, "Lima", 7.0), (40, "Riga", 8.0)], None, NAMES)


@pytest.fixture()
def doubtful(spark):
    return literal_frame(spark, [(30, "Pune", 0.0), (30, "Poona", 0.5), (50, "Cork", 9.0), (50, "Corcaigh", 9.5)],
                         None, NAMES)


def test_literal_schemas(target, january):
    assert target.schema.simpleString() == "struct<city_id:smallint,city:string,visits:double>"
    assert not target.schema["city_id"].nullable and target.isEmpty()
    assert january.schema.simpleString() == "struct<city_id:bigint,city:string,visits:double>"


def test_updates_replace_rows_and_others_are_inserted(target, january, february):
    loaded = upsert(target, january, ["city_id"])
    assert loaded.schema["city_id"].dataType.simpleString() == "smallint"
    after = upsert(loaded, february, ["city_id"])
    assert rows(after) == [(10, "Oslo", 1.5), (20, "Lima", 7.0), (30, "Pune", 3.5), (40, "Riga", 8.0)]


def test_ambiguous_update_fails_and_changes_nothing(target, january, doubtful):
    loaded = upsert(target, january, ["city_id"])
    before = rows(loaded)
    assert rows(cardinality_violations(loaded, doubtful, ["city_id"])) == [(30, 2)]
    with pytest.raises(MergeCardinalityError):
        upsert(loaded, doubtful, ["city_id"])
    assert rows(loaded) == before


def test_duplicates_matching_nothing_are_inserted(target, doubtful):
    assert len(rows(upsert(target, doubtful, ["city_id"]))) == 4


def test_delete_missing(target, january, february):
    loaded = upsert(target, january, ["city_id"])
    assert rows(upsert(loaded, february, ["city_id"], delete_missing=True)) == [(20, "Lima", 7.0), (40, "Riga", 8.0)]


@pytest.mark.parametrize("partitions", [None, 4])
def test_null_keys_never_match(spark, partitions):
    old = spark.createDataFrame([(1, "t1"), (None, "tn")], "k bigint, v string")
    new = spark.createDataFrame([(1, "s1"), (None, "sn"), (None, "sn2")], "k bigint, v string")
    assert rows(upsert(old, new, ["k"], partitions=partitions)) == sorted(
        [(None, "tn"), (1, "s1"), (None, "sn"), (None, "sn2")], key=repr)


def test_null_keys_do_not_meet_in_one_task(spark):
    old = spark.createDataFrame([(1, "t1")], "k bigint, v string")
    new = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") < 0, F.col("id")).alias("k"),
                                            F.col("id").cast("string").alias("v"))
    merged = upsert(old, new, ["k"], check=False, partitions=4)
    held = merged.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held < 1000


def test_key_side_given_by_the_caller(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k bigint, v string")
    assert rows(upsert(old, new, ["k"], check=False, key_side=new.select("k"))) == [(1, "a"), (2, "B"), (3, "C")]


def test_narrowing_overflow_fails(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(2 ** 40, "b")], "k bigint, v string")
    with pytest.raises(Exception):
        upsert(old, new, ["k"]).collect()


def test_null_into_not_null_fails(target, spark):
    new = spark.createDataFrame([(None, "Bonn", 1.0)], "city_id bigint, city string, visits double")
    with pytest.raises(Exception, match="NOT NULL"):
        upsert(target, new, ["city_id"]).collect()


def test_merge_twice_equals_once(spark):
    old = spark.range(0, 100).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    new = spark.range(50, 150).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    once = upsert(old, new, ["k"])
    assert rows(upsert(once, new, ["k"])) == rows(once)
