"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.predicates import date_class, is_blank, not_in


class DataQualityError(ValueError):
    """Raised when an expectation fails; ``failures`` lists them."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        super().__init__(f"{len(failures)} data quality checks failed: {failures}")


def check_not_blank(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Blank entries over all key columns, row count and verdict, from one scan."""
    blanks = reduce(lambda a, b: a + b, [F.count_if(is_blank(c)) for c in columns])
    return df.agg(blanks.alias("null_entries"), F.count(F.lit(1)).alias("entries")).select(
        F.lit(table).alias("table_name"),
        "null_entries",
        "entries",
        F.when((F.col("null_entries") < 1) & (F.col("entries") > 0), "OK").otherwise("NOK").alias("status"),
    )


def check_not_empty(df: DataFrame) -> bool:
    return not df.isEmpty()


def dq_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One report row per table."""
    rows = [check_not_blank(df, columns, name) for name, (df, columns) in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def expect_sql(spark: SparkSession, checks: Sequence[tuple[str, str, object]], strict: bool = True) -> DataFrame:
    """Compare the scalar of each SQL text with an expected value.

    All checks run as one job whose result has one row per check. With
    ``strict`` a failed check raises, after all have been evaluated.
    """
    results = [_scalar(spark, name, sql, expected) for name, sql, expected in checks]
    report = reduce(DataFrame.unionByName, results).withColumn(
        "status", F.when(F.col("actual").eqNullSafe(F.col("expected")), "OK").otherwise("NOK")
    )
    if not strict:
        return report
    # A row per check: the answer is kept rather than worked out again.
    found = report.collect()
    failed = [r.asDict() for r in found if r["status"] != "OK"]
    if failed:
        raise DataQualityError(failed)
    return spark.createDataFrame(found, report.schema)


def _scalar(spark: SparkSession, name: str, sql: str, expected) -> DataFrame:
    answer = spark.sql(sql)
    return answer.select(
        F.lit(name).alias("check_name"),
        F.col(f"`{answer.columns[0]}`").cast("string").alias("actual"),
        F.lit(None if expected is None else str(expected)).cast("string").alias("expected"),
    )


def check_domain(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values outside the domain, and the rows that carry them."""
    return df.where(not_in(column, values)).groupBy(column).agg(F.count(F.lit(1)).alias("entries"))


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Distinct foreign keys without a dim member."""
    keys = fact.select(fk).where(F.col(fk).isNotNull()).distinct()
    return keys.join(dim.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def classify_dates(df: DataFrame, column: str, name: str = "date_class", **rules) -> DataFrame:
    """Rows per date verdict; see :func:`starforge.functions.predicates.date_class`."""
    return df.select(date_class(column, **rules).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("entries"))


def coverage(df: DataFrame, column: str, patterns: Mapping[str, str]) -> DataFrame:
    """How many lines each pattern matches, from one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("entries"),
        *[F.count_if(F.col(column).rlike(p)).alias(name) for name, p in patterns.items()],
    )


def uncovered(df: DataFrame, column: str, strict: str, lenient: str) -> DataFrame:
    """Lines that only the lenient pattern reads: those to repair."""
    return df.where(F.col(column).rlike(lenient) & ~F.col(column).rlike(strict))
