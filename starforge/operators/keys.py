"""Dense surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise, path_exists

# monotonically_increasing_id puts the partition above bit 33 and the row below.
_ROW_BITS = 33


def with_row_id(df: DataFrame, id_column: str, order_by: Sequence[str], start: int = 1) -> DataFrame:
    """Ids start, start+1, ... in the order of a unique key, without a global sort task.

    The rows are range-partitioned and sorted once and written to the shared
    folder with their position, so both later passes see the same layout even
    when an executor is lost. The first pass counts rows per partition; the
    running total of those counts (one row per partition) is the only data that
    meets in one task or is broadcast.
    """
    placed = materialise(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "row-id",
    )
    placed = placed.withColumn("_part", F.shiftright("_pos", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    offset = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(id_column, F.lit(start) + F.col("_base") + offset)
        .drop("_part", "_pos", "_base")
    )


def append_with_ids(target: str, batch: DataFrame, id_column: str, order_by: Sequence[str]) -> int:
    """Append a batch whose ids continue after the largest id of the target."""
    spark = batch.sparkSession
    last = 0
    if path_exists(spark, target):
        last = spark.read.parquet(target).agg(F.max(id_column)).first()[0] or 0
    with_row_id(batch, id_column, order_by, start=last + 1).write.mode("append").parquet(target)
    return last
