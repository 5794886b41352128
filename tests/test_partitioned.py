"""Upserts that touch only the partitions of their keys."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabulon.operators.merge import MergeCardinalityError
from tabulon.sinks.partitioned import PART, PartitionedTable, hashed

SCHEMA = StructType([StructField("k", LongType()), StructField("v", StringType())])


@pytest.fixture()
def make(spark):
    made = []

    def build(part, rows=10_000):
        table = PartitionedTable(spark, f"parts_{uuid.uuid4().hex[:10]}", SCHEMA, ["k"], part)
        made.append(table)
        table.upsert(spark.range(rows).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v")), check=False)
        return table

    yield build
    for table in made:
        table.drop()


def files(table, spark, where="true"):
    return {f.removeprefix("file:"): os.path.getsize(f.removeprefix("file://").removeprefix("file:"))
            for f in spark.table(table.name).where(where).inputFiles()}


def test_a_clustered_update_reads_and_writes_its_partitions_only(spark, make):
    table = make("k div 100")  # a hundred partitions
    before = files(table, spark)
    update = spark.range(4_200, 4_300).select(F.col("id").alias("k"), F.lit("new").alias("v"))  # 1 % of the keys
    target = spark.table(table.name).where(F.col(PART).isin([42]))
    assert all("/_part=42/" in f for f in target.inputFiles())
    assert table.upsert(update) == [42]
    after = files(table, spark)
    kept = before.keys() & after.keys()
    written = sum(after[f] for f in after.keys() - kept)
    assert kept == {f for f in before if "_part=42" not in f}
    assert written < 0.03 * sum(after.values())
    got = table.read()
    assert got.count() == 10_000 and got.where("v = 'new'").count() == 100


def test_hashed_keys_touch_every_partition(spark, make):
    """The stated worst case: a hundred rows of 1 % fall into all of sixteen partitions."""
    table = make(hashed(["k"], 16))
    before = files(table, spark)
    touched = table.upsert(spark.range(4_200, 4_300).select(F.col("id").alias("k"), F.lit("new").alias("v")))
    assert touched == list(range(16))
    assert not before.keys() & files(table, spark).keys(), "the whole table is rewritten"
    assert table.read().where("v = 'new'").count() == 100


def test_inserts_null_keys_and_repeated_runs(spark, make):
    table = make("k div 5000")
    update = spark.createDataFrame([(1, "a"), (25_000, "b"), (None, "c")], "k bigint, v string")
    for _ in range(2):
        assert table.upsert(update.where("k is not null")) == [0, 5]
    assert table.upsert(update.where("k is null")) == [-1]
    assert table.partitions() == {-1, 0, 1, 5}
    assert table.read().count() == 10_002
    assert sorted(tuple(r) for r in table.read().where("v in ('a', 'b', 'c')").collect() if r.k) == [(1, "a"), (25_000, "b")]
    assert table.upsert(update.limit(0)) == []


def test_two_rows_for_one_target_row_change_nothing(spark, make):
    table = make("k div 1000")
    before = files(table, spark)
    with pytest.raises(MergeCardinalityError):
        table.upsert(spark.createDataFrame([(7, "x"), (7, "y")], "k bigint, v string"))
    assert files(table, spark) == before


def test_an_update_of_too_many_partitions_is_refused(spark, make, monkeypatch):
    import tabulon.sinks.partitioned as partitioned

    table = make("k div 1000")
    monkeypatch.setattr(partitioned, "MAX_PARTITIONS", 3)
    with pytest.raises(ValueError, match="touches more than 3"):
        table.upsert(spark.range(10_000).select(F.col("id").alias("k"), F.lit("x").alias("v")))
