"""Date series and date dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import date_parts
from .aggregates import bounds


def date_series(spark: SparkSession, start: dt.date, stop: dt.date, step: int = 1, name: str = "date") -> DataFrame:
    """Every ``step`` days from start to stop, both included. Pure date arithmetic."""
    days = (stop - start).days
    return spark.range(0, days + 1, step).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias(name)
    )


def date_series_of(df: DataFrame, column: str, ignore=None, name: str = "date") -> DataFrame:
    """The days between the smallest and largest date of a column.

    The bounds stay in the plan: one aggregated row that is exploded.
    """
    dated = df.select(F.col(column).cast("date").alias("_d"))
    span = bounds(dated, "_d", ignore=ignore, lo="_lo", hi="_hi")
    return span.where(F.col("_lo").isNotNull()).select(
        F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias(name)
    )


def date_dimension(days: DataFrame, column: str, prefix: str) -> DataFrame:
    """Date, id and ten calendar columns, all carrying ``prefix``."""
    return days.select(
        F.col(column).alias(f"{prefix}date"),
        *[c.alias(f"{prefix}{n}") for n, c in date_parts(F.col(column)).items()],
    )


def build_date_dimension(df: DataFrame, column: str, prefix: str, default: str | None = None) -> DataFrame:
    """Calendar of a date column; ``default`` adds the sentinel day as a member."""
    days = date_series_of(df, column, ignore=default)
    if default is not None:
        days = days.unionByName(df.sparkSession.range(1).select(F.lit(default).cast("date").alias("date")))
    return date_dimension(days, "date", prefix)
