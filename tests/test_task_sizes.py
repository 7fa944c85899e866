"""What one task reads stays bounded, whatever the session's number of partitions."""

import pytest
from pyspark.sql import functions as F

from starforge.session import TASK_SETTINGS
from starforge.workload import QUERIES


@pytest.fixture
def tables(spark, tmp_path):
    ids = spark.range(300)
    ids.selectExpr(
        "id % 7 AS l_partkey", "id % 5 AS l_suppkey", "id AS l_orderkey"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    ids.where("id < 7").selectExpr("id AS p_partkey", "'p' AS p_name", "1 AS p_size", "1.5D AS p_retailprice").write.parquet(
        str(tmp_path / "part.parquet")
    )
    ids.where("id < 5").selectExpr("id AS s_suppkey", "concat('s', id) AS s_name", "1 AS s_nationkey", "1D AS s_acctbal").write.parquet(
        str(tmp_path / "supplier.parquet")
    )
    spark.createDataFrame([(1, "n")], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    before = {key: spark.conf.get(key, None) for key in TASK_SETTINGS}
    yield str(tmp_path)
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["most_bought_parts", "dim_product"])
def test_shuffles_start_with_many_partitions(spark, plan, tables, name):
    """The session has 4: a task would read a quarter of any table."""
    found = QUERIES[name](spark, tables)
    many = TASK_SETTINGS["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    assert f", {many})" in plan(found) and ", 4)" not in plan(found)
    assert found.count() == (5 if name == "most_bought_parts" else 35)


def test_scans_are_cut_small(spark, tables):
    QUERIES["most_bought_parts"](spark, tables)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == TASK_SETTINGS["spark.sql.files.maxPartitionBytes"]
    assert spark.range(1).agg(F.max("id")).first()[0] == 0
