"""Group counts, profiles and bounds, each in one pass over its input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType


def group_count(df: DataFrame, keys: Sequence[str], name: str = "entries") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_profile(
    df: DataFrame, keys: Sequence[str], rounded: Mapping[str, tuple[str, int]], whole: Mapping[str, str] = {}
) -> DataFrame:
    """Averages per group: rounded to n digits, or cut to the whole number."""
    return df.groupBy(*keys).agg(
        *[F.round(F.avg(c), digits).alias(out) for out, (c, digits) in rounded.items()],
        *[F.avg(c).cast("int").alias(out) for out, c in whole.items()],
    )


def bounds(df: DataFrame, column: str, ignore=None, lo: str = "min_value", hi: str = "max_value") -> DataFrame:
    """Smallest and largest value as one row; ``ignore`` is left out of both."""
    c = F.col(column)
    if ignore is not None:
        c = F.when(c != F.lit(ignore).cast(df.schema[column].dataType), c)
    return df.agg(F.min(c).alias(lo), F.max(c).alias(hi))


def distinct_except(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Distinct rows apart from the id columns; the smallest id is kept."""
    rest = [c for c in df.columns if c not in ids]
    return df.groupBy(*rest).agg(*[F.min(i).alias(i) for i in ids]).select(*df.columns)


def dup_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and surplus rows. Rows with nulls are counted too."""
    return (
        df.groupBy(*(columns or df.columns))
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("entries"),
            F.count(F.lit(1)).alias("distinct_entries"),
        )
        .withColumn("duplicates", F.col("entries") - F.col("distinct_entries"))
    )


def unique_check(df: DataFrame, column: str) -> DataFrame:
    """Non-null count against distinct count of an id."""
    profile = dup_profile(df.where(F.col(column).isNotNull()), [column])
    return profile.select(
        F.lit(column).alias("column_name"),
        "entries",
        "distinct_entries",
        (F.col("duplicates") == 0).alias("is_unique"),
    )


def _per_column(df: DataFrame, exprs: Mapping[str, object], value: str) -> DataFrame:
    one_row = df.agg(*[e.alias(name) for name, e in exprs.items()])
    return one_row.unpivot([], list(exprs), "column_name", value)


def missing_ratio(df: DataFrame, digits: int = 6) -> DataFrame:
    return _per_column(
        df,
        {c: F.round(1 - F.count(F.col(c)) / F.count(F.lit(1)), digits) for c in df.columns},
        "missing_ratio",
    )


def null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, {c: F.count_if(F.col(c).isNull()) for c in df.columns}, "null_entries")


def non_null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, {c: F.count(F.col(c)) for c in df.columns}, "entries")


def describe(df: DataFrame, digits: int = 4) -> DataFrame:
    """Count, mean, standard deviation, min and max of every numeric column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    stats = F.array(
        *[
            F.struct(
                F.lit(n).alias("column_name"),
                F.col(f"{n}_count").alias("entries"),
                F.round(F.col(f"{n}_mean"), digits).alias("mean"),
                F.round(F.col(f"{n}_std"), digits).alias("stddev"),
                F.col(f"{n}_min").alias("min_value"),
                F.col(f"{n}_max").alias("max_value"),
            )
            for n in names
        ]
    )
    one_row = df.agg(
        *[
            e
            for n in names
            for e in (
                F.count(n).alias(f"{n}_count"),
                F.avg(n).alias(f"{n}_mean"),
                F.stddev(n).alias(f"{n}_std"),
                F.min(n).cast("double").alias(f"{n}_min"),
                F.max(n).cast("double").alias(f"{n}_max"),
            )
        ]
    )
    return one_row.select(F.inline(stats))


def value_frequencies(df: DataFrame, column: str, name: str = "entries", by: str = "value") -> DataFrame:
    """Values with their number of rows, by value or the most frequent first."""
    if by not in ("value", "entries"):
        raise ValueError(f"by must be 'value' or 'entries', got {by!r}")
    order = [F.col(column)] if by == "value" else [F.col(name).desc(), F.col(column)]
    return group_count(df, [column], name).orderBy(*order)
