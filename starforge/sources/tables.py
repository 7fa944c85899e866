"""Catalogue tables and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from .rejects import as_schema

PRIMARY_KEY, NOT_NULL = "primary_key", "not_null"


@dataclass(frozen=True)
class Layout:
    """How a table's rows lie on disk: ``buckets`` hash buckets of ``bucket_by``,
    one file each, sorted by ``sort_by`` inside.

    Tables with as many buckets of their join keys join without an exchange, and
    an aggregate by the bucket columns needs none either. All rows of a key are
    in one bucket, so a key that holds much of a table is better served by a
    salted lookup than by a layout.
    """

    bucket_by: tuple[str, ...]
    buckets: int
    sort_by: tuple[str, ...] = ()

    def clause(self) -> str:
        """The part of CREATE TABLE that states the layout."""
        order = f" SORTED BY ({_names(self.sort_by)})" if self.sort_by else ""
        return f" CLUSTERED BY ({_names(self.bucket_by)}){order} INTO {self.buckets} BUCKETS"


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def save_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    mode: str = "overwrite",
    layout: Layout | None = None,
) -> DataFrame:
    """Save as a catalogue table; ``path`` makes it external."""
    out = df
    if layout is not None:
        # The shuffle that Spark's bucket numbers follow: a task writes one bucket.
        out = df.repartition(layout.buckets, *layout.bucket_by)
    elif partition_by:
        # As for plain writes: one file for a small partition, several tasks for a large one.
        out = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = out.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if layout is not None:
        writer = writer.bucketBy(layout.buckets, *layout.bucket_by)
        if layout.sort_by:
            writer = writer.sortBy(*layout.sort_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def described(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """``df`` with a comment on each of the columns named, kept by what saves it."""
    unknown = set(comments) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.withColumns(
        {c: F.col(f"`{c}`").alias(c, metadata={**df.schema[c].metadata, "comment": text}) for c, text in comments.items()}
    )


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: StructType | str,
    location: str | None = None,
    partition_by: Sequence[str] = (),
    layout: Layout | None = None,
    primary_key: Sequence[str] = (),
    comment: str | None = None,
) -> None:
    """Create the table where it is missing.

    Columns keep their type, their comment (metadata ``comment``) and whether they
    take nulls; those of ``primary_key`` take none. Spark stores NOT NULL and the
    key but does not enforce them on Parquet: load with ``load_table``, which does.
    """
    fields = as_schema(schema).fields
    columns = ", ".join(map(_column, fields))
    clauses = " USING parquet"
    if partition_by:
        clauses += f" PARTITIONED BY ({_names(partition_by)})"
    if layout is not None:
        clauses += layout.clause()
    if location:
        clauses += f" LOCATION {_text(location)}"
    if comment:
        clauses += f" COMMENT {_text(comment)}"
    not_null = [f.name for f in fields if not f.nullable or f.name in primary_key]
    kept = {PRIMARY_KEY: primary_key, NOT_NULL: not_null}
    properties = ", ".join(f"'{k}' = {_text(','.join(names))}" for k, names in kept.items() if names)
    if properties:
        clauses += f" TBLPROPERTIES ({properties})"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}){clauses}")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column(field: StructField) -> str:
    comment = f" COMMENT {_text(field.metadata['comment'])}" if "comment" in field.metadata else ""
    return f"`{field.name}` {field.dataType.simpleString()}{comment}"


def table_constraints(spark: SparkSession, name: str) -> tuple[list[str], list[str]]:
    """The columns of a catalogue table that take no nulls, and its primary key."""
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    not_null, key = ([c for c in kept.get(k, "").split(",") if c] for k in (NOT_NULL, PRIMARY_KEY))
    return not_null, key


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def truncate_table(spark: SparkSession, name: str) -> None:
    """Remove all rows; an external table, which TRUNCATE refuses, is overwritten with none."""
    if spark.catalog.getTable(name).tableType == "EXTERNAL":
        spark.createDataFrame([], spark.table(name).schema).write.insertInto(name, overwrite=True)
    else:
        spark.sql(f"TRUNCATE TABLE {name}")
