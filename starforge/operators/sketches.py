"""Distinct counts by mergeable sketches: a total is kept up without a rescan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Registers as a power of two: a sketch takes about 2**(LG_K - 1) bytes.
LG_K = 14


def error_bound(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The relative error that an estimate of merged sketches stays under but for
    about 0.3 % of cases (three standard errors of 1.04 / sqrt(registers))."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """``by ..., column_name, entries, sketch``: the non-null entries of each column
    and a sketch of its values, per group of ``by`` (a load, a partition).

    One aggregate over one scan; what is shuffled is a sketch per group, column
    and task.
    """
    parts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.col(c)).alias("entries"),
            # Values of any type are compared by their text.
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias("sketch"),
        )
        for c in columns
    ]
    grouped = df.groupBy(*by).agg(F.array(*parts).alias("_parts"))
    return grouped.select(*by, F.inline("_parts"))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """``column_name, entries, sketch`` over all groups that were kept."""
    return sketches.groupBy("column_name").agg(
        F.sum("entries").alias("entries"), F.hll_union_agg("sketch", F.lit(False)).alias("sketch")
    )


def estimate(sketch: Column | str) -> Column:
    return F.hll_sketch_estimate(sketch)


def unique_candidates(sketches: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``column_name, entries, distinct_estimate, may_be_unique`` from kept sketches.

    A column whose estimate is below its entries by more than the bound has
    repeated values; only of the others an exact check (``unique_check``) is
    worth its shuffle. A column with fewer repeats than the bound passes as well.
    """
    merged = merged_sketches(sketches).withColumn("distinct_estimate", estimate("sketch"))
    least = F.col("entries") * (1 - error_bound(lg_k))
    return merged.select("column_name", "entries", "distinct_estimate", (F.col("distinct_estimate") >= least).alias("may_be_unique"))
