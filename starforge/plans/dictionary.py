"""Data dictionary of a set of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.readers import scan_csv
from ..sources.tables import table_constraints
from ..sources.writers import write_csv

NOT_SET = "not set"


def data_dictionary(
    tables: Mapping[str, DataFrame],
    table_descriptions: Mapping[str, str] | None = None,
    column_descriptions: Mapping[tuple[str, str], str] | None = None,
    with_entries: bool = False,
    not_null: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per column: position, type, nullability and descriptions.

    Missing descriptions read "not set"; ``not_null`` names columns that take no
    nulls though their schema does not say so. Without ``with_entries`` only schemas
    are looked at; with it the row count and the non-null entries of every
    column are added, from one scan per table.
    """
    table_text = table_descriptions or {}
    column_text = column_descriptions or {}
    parts = []
    for table, df in tables.items():
        if with_entries:
            source = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
        else:
            source = df.sparkSession.range(1)
        rows = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(table_text.get(table, NOT_SET)).alias("table_description"),
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(column_text.get((table, f.name), NOT_SET)).alias("column_description"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                F.lit(f.nullable and f.name not in (not_null or {}).get(table, ())).alias("column_nullable"),
                *([F.col("_rows").alias("table_entries"), F.col(f.name).alias("column_entries")] if with_entries else []),
            )
            for i, f in enumerate(df.schema.fields, start=1)
        ]
        parts.append(source.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def catalogue_dictionary(spark: SparkSession, names: Mapping[str, str], with_entries: bool = False) -> DataFrame:
    """The dictionary of catalogue tables (table name in the dictionary to name in
    the catalogue), from what the catalogue holds alone: comments of tables and
    columns, types, and the columns that take no nulls."""
    tables = {shown: spark.table(name) for shown, name in names.items()}
    table_text = {shown: spark.catalog.getTable(name).description for shown, name in names.items()}
    column_text = {
        (shown, c.name): c.description
        for shown, name in names.items()
        for c in spark.catalog.listColumns(name)
        if c.description
    }
    not_null = {shown: table_constraints(spark, name)[0] for shown, name in names.items()}
    texts = {shown: text for shown, text in table_text.items() if text}
    return data_dictionary(tables, texts, column_text, with_entries, not_null)


def export_dictionary(rows: DataFrame, path: str) -> DataFrame:
    """Write the dictionary as CSV with all fields quoted, and return its scan."""
    return scan_csv(rows.sparkSession, write_csv(rows, path, quote_all=True), rows.schema)
