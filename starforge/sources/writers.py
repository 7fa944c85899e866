"""Partition-aware writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    sort_within: Sequence[str] = (),
    compression: str | None = None,
    max_records_per_file: int | None = None,
    counted: Observation | None = None,
    dealt: bool = False,
) -> str:
    """Write Parquet laid out by ``partition_by``; ``counted`` observes the number
    of rows as ``rows``.

    Rows are rebalanced on the partition columns first: small partitions end up
    in one file, and a partition that holds much of the data is split by AQE
    over several tasks, so no single task has to write it. ``dealt`` says that the
    rows are with their partition already: see ``deal``.
    """
    out = df
    if partition_by and not dealt:
        out = deal(out, *partition_by)
    if sort_within:
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    if counted is not None:
        # Above the shuffle: below it Spark may skip the step where there are no rows.
        out = out.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def deal(df: DataFrame, *partition_by: str) -> DataFrame:
    """Rebalance rows for a write partitioned by these columns. Columns that follow
    from others can then be worked out afterwards, so that they are not shuffled."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def write_csv(
    df: DataFrame,
    path: str,
    quote_all: bool = False,
    compression: str | None = None,
    mode: str = "overwrite",
) -> str:
    writer = (
        df.write.mode(mode)
        .option("header", True)
        .option("quoteAll", quote_all)
        .option("escape", '"')
        .option("emptyValue", "")
    )
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines, written by the executors."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("lineSep", "\n").text(path)
    return path
