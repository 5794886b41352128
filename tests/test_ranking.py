"""Global ranks and running totals, held against plain Python."""

import random

from pyspark.sql import functions as F

from tabulon.operators.profile import values_ranked
from tabulon.operators.ranking import global_rank, running_total


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(i, None if rng.random() < 0.1 else rng.randrange(5), rng.randrange(100)) for i in range(n)]


def test_rank_and_total_over_ties_and_nulls(spark):
    data = rows(3_000)
    df = spark.createDataFrame(data, "id int, k int, v long").repartition(7)
    order = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, -r[2], r[0]))
    got = running_total(df, ["k", F.desc("v"), "id"], "v", "total", rank="place").collect()
    total, want = 0, []
    for place, (i, k, v) in enumerate(order, 1):
        total += v
        want.append((i, k, v, total, place))
    assert sorted(map(tuple, got), key=lambda r: r[4]) == want
    ranks = global_rank(df, ["k", F.desc("v"), "id"])
    assert {r.id: r["rank"] for r in ranks.collect()} == {w[0]: w[4] for w in want}


def test_one_key_on_all_rows_is_spread_by_the_last_order_column(spark):
    df = spark.range(5_000).select(F.lit(1).alias("k"), F.col("id"), F.lit(2).cast("long").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_total(df, ["k", "id"], "v")
        assert got.agg(F.max("running"), F.count_distinct("running")).first() == (10_000, 5_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_window_over_all_rows(spark):
    plan = global_rank(spark.range(100), ["id"])._jdf.queryExecution().executedPlan().toString()
    rows_side = plan[plan.index("BroadcastHashJoin"):]
    assert rows_side.count("SinglePartition") == 1, "only the table of ranges is in one partition"


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([(1, 5, 6)], "_at long, _block long, _before long")
    assert [tuple(r) for r in running_total(df, ["_at"], "_block").collect()] == [(1, 5, 6, 5)]
    assert global_rank(df.limit(0), ["_at"]).collect() == []
    assert [tuple(r) for r in values_ranked(df, "_block", ["_at"]).collect()] == [(1, 5, 1)]
