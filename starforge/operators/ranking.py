"""Ranks over aggregated groups, and top-k with ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise

def rank_bounded(groups: DataFrame, measure: str, name: str = "rank", dense: bool = False) -> DataFrame:
    """Rank groups whose number has a fixed bound (calendar months, countries, levels)."""
    fn = F.dense_rank() if dense else F.rank()
    return groups.withColumn(name, fn.over(Window.orderBy(F.col(measure).desc())))


def rank_groups(groups: DataFrame, measure: str, name: str = "rank", dense: bool = False) -> DataFrame:
    """Rank groups by ``measure``, largest first, nulls last, for any number of groups.

    The groups are range-partitioned by measure and a hash, so that a measure
    shared by most groups is spread too, and written once. The ranks are worked
    out on one row per range partition and measure: the rows of the partitions
    before, less those with the same measure, plus the rows above in the
    partition. What meets in one task or is broadcast is one row per partition.
    """
    largest = F.col(measure).desc_nulls_last()
    placed = materialise(
        groups.repartitionByRange(largest, F.xxhash64(*groups.columns)).withColumn("_part", F.spark_partition_id()),
        "rank-groups",
    )
    values = placed.groupBy("_part", measure).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A measure is in several partitions only if it fills those in between.
    same = Window.partitionBy(measure).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("_part").orderBy(largest).rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("_same", F.coalesce(F.sum("_n").over(same), F.lit(0)))
    # For dense ranks a measure counts once, where it is first seen.
    values = values.withColumn("_weight", (F.col("_same") == 0).cast("long") if dense else F.col("_n"))
    starts = values.groupBy("_part").agg(F.sum("_weight").alias("_w"))
    starts = starts.select("_part", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_base"))
    seen = (F.col("_same") > 0).cast("long") if dense else F.col("_same")
    ranks = values.join(F.broadcast(starts), "_part").select(
        F.col("_part").alias("_at"),
        F.col(measure).alias("_value"),
        (F.col("_base") + F.coalesce(F.sum("_weight").over(above), F.lit(0)) - seen + 1).cast("int").alias(name),
    )
    matched = (placed["_part"] == ranks["_at"]) & placed[measure].eqNullSafe(ranks["_value"])
    return placed.join(ranks, matched).drop("_part", "_at", "_value")


def top_k_groups(groups: DataFrame, measure: str, k: int, name: str = "rank") -> DataFrame:
    """Groups of rank <= k, ties included.

    The k largest measures come from a distributed top-k; only those (at most k
    rows) are ranked in one task and broadcast. A tie at rank k may return more
    than k groups, all of them.
    """
    best = groups.select(F.col(measure).alias("_value")).orderBy(F.col("_value").desc()).limit(k)
    ranks = best.select("_value", F.rank().over(Window.orderBy(F.col("_value").desc())).alias(name)).distinct()
    return groups.join(F.broadcast(ranks), groups[measure] == ranks["_value"]).drop("_value")


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first n rows in a stated order (distributed top-n, no full sort)."""
    return df.orderBy(*order).limit(n)
