"""Shapes of physical plans that matter at scale."""

import os

import pytest
from pyspark.sql import functions as F

from starforge import sources
from starforge.operators import joins, keys, ranking
from starforge.workload import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_dims_are_broadcast_and_large_ones_are_not(spark, plan, tmp_path, request):
    fact = spark.range(1000).withColumn("k", F.col("id") % 10)
    path = str(tmp_path / "dim")
    spark.range(10).withColumn("v", F.col("id")).write.parquet(path)
    dim = spark.read.parquet(path)
    look = lambda: joins.lookup_join(fact, dim, {"k": "id"}, {"v": "v"})
    assert "BroadcastHashJoin" in plan(look())
    request.getfixturevalue("no_broadcast")
    text = plan(look())
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_row_ids_window_only_over_partition_counts(spark, plan):
    text = plan(keys.with_row_id(spark.range(100), "n", ["id"]))
    window_part = text[text.index("Window"):]
    assert "HashAggregate(keys=[_part" in window_part and text.count("SinglePartition") == 1


def test_rank_groups_has_no_global_window_over_groups(spark, plan):
    df = spark.range(100).withColumn("n", F.col("id") % 7)
    text = plan(ranking.rank_groups(df, "n", "r"))
    # The one task sees a row per range partition.
    assert text.count("SinglePartition") == 1
    below = text[text.index("SinglePartition"):]
    assert "HashAggregate(keys=[_part" in below


def test_null_safe_anti_join_is_a_hash_or_merge_join(spark, plan, no_broadcast):
    text = plan(joins.anti(spark.range(10), spark.range(5), ["id"]))
    assert "SortMergeJoin" in text and "NestedLoop" not in text


def test_latest_row_needs_one_shuffle(spark, plan):
    df = spark.range(100).selectExpr("id % 5 AS k", "id AS ts", "cast(id AS string) AS v")
    assert plan(joins.latest_by(df, ["k"], ["ts"], ["v"])).count("Exchange") == 1


def test_star_query_aggregates_before_the_join(spark, plan, no_broadcast):
    fact = spark.range(100).selectExpr("id % 5 AS fk", "id AS v")
    dim = spark.range(5).selectExpr("id AS pk", "cast(id AS string) AS name")
    text = plan(joins.star_query(fact, [(dim, "fk", "pk", "inner")], {"name": "name"}, {"n": ("count", "v")}))
    below_join = text[text.index("SortMergeJoin"):]
    assert "HashAggregate(keys=[fk" in below_join


def test_hot_join_key_is_split_at_run_time(spark, plan, no_broadcast):
    """A plain lookup whose fact has a third of its rows on one key."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(60_000, numPartitions=8).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k")
        )
        dim = spark.range(-1, 2000).select(F.col("id").alias("key"), F.lit("x").alias("v"))
        found = joins.lookup_join(fact, dim, {"k": "key"}, {"v": "v"})
        assert len(found.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(found)
    finally:
        for key in settings:
            spark.conf.unset(key)


LAZY = [n for n in QUERIES if not n.startswith(("stream", "question", "staged"))]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")
def test_no_query_uses_cross_joins_or_python_rows(spark, plan, no_broadcast):
    for name in LAZY:
        text = plan(QUERIES[name](spark, DATA))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
            assert word not in text, (name, word)


def test_null_lookup_keys_are_spread_over_tasks(spark, no_broadcast):
    fact = spark.range(40_000, numPartitions=4).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
    dim = spark.range(100).select(F.col("id").alias("key"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = joins.lookup_join(fact, dim, {"k": "key"}, {"v": "v"}).withColumn("task", F.spark_partition_id())
        tasks = found.where("k is null").groupBy("task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 5_000


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")
def test_no_single_task_sees_the_groups_of_a_ranked_report(spark, plan):
    text = plan(QUERIES["star_rank_supplier"](spark, DATA))
    assert text.count("SinglePartition") == 1
    assert "HashAggregate(keys=[_part" in text[text.index("SinglePartition"):]


def test_tables_of_one_layout_join_and_total_without_an_exchange(spark, plan, tmp_path, no_broadcast):
    for name in ("laid_a", "laid_b"):
        frame = spark.range(1000).withColumn("v", F.col("id") % 7)
        sources.save_table(frame, name, path=str(tmp_path / name), layout=sources.Layout(("id",), 4, ("id",)))
        assert len(list((tmp_path / name).glob("*.parquet"))) == 4
    a, b = spark.table("laid_a"), spark.table("laid_b").withColumnRenamed("v", "w")
    text = plan(a.join(b, "id").groupBy("id").agg(F.sum("v"), F.max("w")))
    assert "SortMergeJoin" in text and "Exchange" not in text
    # Tables without the layout do move.
    assert "Exchange" in plan(spark.range(1000).join(spark.range(50), "id"))
    for name in ("laid_a", "laid_b"):
        sources.drop_table(spark, name)


def test_a_period_of_the_calendar_prunes_the_scan_of_the_fact(spark, plan, tmp_path):
    fact = spark.range(2400).select("id", (F.col("id") % 2 + 2020).alias("y"), (F.col("id") % 12 + 1).alias("m"))
    path = sources.write_parquet(fact, str(tmp_path / "fact"), ["y", "m"])
    days = spark.range(731).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    calendar = sources.write_parquet(days.select("d", F.year("d").alias("cy"), F.month("d").alias("cm")), str(tmp_path / "days"))
    quarter = spark.read.parquet(calendar).where(F.quarter("d") == 1)
    picked = joins.within(spark.read.parquet(path), quarter, {"y": "cy", "m": "cm"})
    text = plan(picked.groupBy("m").count())
    assert text.count("dynamicpruning") >= 2 and "PartitionFilters: [" in text
    assert picked.select("m").distinct().count() == 3 and picked.count() == 600
