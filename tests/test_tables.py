import pytest

from tabulon.schema import ORDERS_SCHEMA
from tabulon.sinks.tables import TableStore


def test_lifecycle(spark, scratch):
    store = TableStore(spark, scratch + "/tables")
    name = "t_" + scratch.rsplit("-", 1)[-1]
    assert store.create_if_absent(name, ORDERS_SCHEMA)
    assert not store.create_if_absent(name, ORDERS_SCHEMA)
    assert store.read(name).count() == 0
    data = spark.createDataFrame([(1, 2, "F", 1.0, None, "x")], ORDERS_SCHEMA)
    v = store.publish(name, data)
    assert v == 1 and store.read(name).count() == 1
    assert spark.sql(f"SELECT count(*) AS n FROM {name}").first().n == 1
    store.replace(name, store.read(name).unionByName(store.read(name)))
    assert store.read(name).count() == 2
    store.reset(name)
    assert store.read(name).count() == 0
    assert store.read(name, 1).count() == 1
    detail = store.detail(name).first()
    assert detail.version == 3 and detail.num_columns == 6
    store.drop(name)


def test_as_of(spark, scratch):
    store = TableStore(spark, scratch + "/tables", register=False)
    for i, label in enumerate(["2024-01-01", "2024-06-01", "2025-01-01"]):
        store.publish("s", spark.range(i + 1), label=label)
    assert store.as_of("s", "2024-07-15").count() == 2
    assert store.as_of("s", "2030-01-01").count() == 3
    with pytest.raises(KeyError):
        store.as_of("s", "2023-01-01")


def test_bucketed_versions_and_upsert(spark, scratch):
    from pyspark.sql import functions as F

    from tabulon.operators.merge import upsert

    store = TableStore(spark, scratch + "/tables")
    name = "b_" + scratch.rsplit("-", 1)[-1]
    base = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    store.publish(name, base, bucket_keys=["k"], buckets=4)
    assert store.bucketing(name) == (["k"], 4)
    master = store.read(name)
    desc = {r.col_name: r.data_type
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED {store._version_table(name, 0)}").collect()}
    assert desc.get("Num Buckets") == "4"
    src = spark.range(990, 1010).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    merged = upsert(master, src, ["k"], partitions=4)
    store.publish(name, merged, bucket_keys=["k"], buckets=4)
    got = {r.k: r.v for r in store.read(name).collect()}
    assert len(got) == 1010 and got[5] == "old" and got[995] == "new" and got[1005] == "new"
    store.reset(name)
    assert store.read(name).count() == 0 and store.bucketing(name) == (["k"], 4)


def test_orphan_version_folder_does_not_block(spark, scratch):
    store = TableStore(spark, scratch + "/tables", register=False)
    store.publish("o", spark.range(3))
    spark.range(99).write.parquet(f"{store.root}/o/v=1")  # a publish that died before logging
    assert store.publish("o", spark.range(5)) == 2  # past the orphan, which is left alone
    assert store.read("o").count() == 5


def test_key_and_not_null_kept_as_properties(spark, scratch):
    store = TableStore(spark, scratch + "/tables")
    name = "p_" + scratch.rsplit("-", 1)[-1]
    store.create_if_absent(name, ORDERS_SCHEMA, keys=["o_orderkey"])
    store.publish(name, spark.createDataFrame([(1, 2, "F", 1.0, None, "x")], ORDERS_SCHEMA))
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert props["tabulon.keys"] == "o_orderkey" and props["tabulon.not_null"] == "o_orderkey"
    store.drop(name)


def test_two_writers_never_replace_a_version(spark, scratch):
    first, second = (TableStore(spark, scratch, register=False) for _ in range(2))
    one, two = spark.range(100), spark.range(3)
    first.publish("t", spark.range(1))
    assert second.current_version("t") == 0
    assert first.publish("t", one) == 1
    assert second.publish("t", two) == 2
    assert first.read("t", 1).count() == 100
    assert first.current_version("t") == 2 and first.read("t").count() == 3


def test_dropped_table_starts_anew(spark, scratch):
    store = TableStore(spark, scratch, register=False)
    store.create_if_absent("t", "k int, v string")
    store.publish("t", spark.createDataFrame([(1, "a")], "k int, v string"), label="2024-01-01")
    store.record_files("t", spark.createDataFrame([("f", 1, None)], "file_name string, size long, modified timestamp"),
                       1, 1)
    store.drop("t")
    assert not store.exists("t") and store.ledger("t").isEmpty()
    assert store.create_if_absent("t", "k int, v string")
    assert store.read("t").count() == 0
    with pytest.raises(KeyError):
        store.as_of("t", "2025-01-01")
    assert not TableStore(spark, scratch, register=False).read("t").count()


def test_null_key_is_not_published(spark, scratch):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from tabulon.sinks.tables import NullViolation

    schema = StructType([StructField("k", LongType(), False), StructField("v", StringType())])
    store = TableStore(spark, scratch, register=False)
    store.create_if_absent("t", schema, ["k"])
    store.publish("t", spark.createDataFrame([(1, None)], "k long, v string"))
    bad = spark.createDataFrame([(None, "x"), (2, "y")], "k long, v string")
    for options in ({}, {"bucket_keys": ["k"], "buckets": 2}):
        with pytest.raises(NullViolation):
            TableStore(spark, scratch, register=False).publish("t", bad, **options)
    assert [tuple(r) for r in store.read("t").collect()] == [(1, None)]


def test_paths_resolve_as_spark_resolves_them(spark, scratch):
    from tabulon import session
    from tabulon.sources.files import fs_for, store_uri

    assert [store_uri(u) for u in ("s3a://b/x", "s3n://b/x", "s3://b/x", "hdfs://nn/x")] == \
        ["s3://b/x", "s3://b/x", "s3://b/x", "hdfs://nn/x"]
    assert fs_for("file:/a/b")[1] == "/a/b"
    with pytest.raises(ValueError, match="dbfs"):
        fs_for("dbfs:/a")
    assert session.qualified(spark, "/a/b").startswith("file:/")
    assert not session.path_exists(spark, f"{scratch}/none")


def test_cluster_without_checkpoint_folder_is_an_error(spark):
    from types import SimpleNamespace
    from tabulon import session

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(cluster)
