"""Schema-first scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .rejects import failing, marked

Paths = str | Sequence[str]


def scan_json(
    spark: SparkSession,
    path: Paths,
    schema: StructType | str | None = None,
    recursive: bool = False,
    with_file: bool = False,
    strict: bool = False,
) -> DataFrame:
    """JSON lines. With a schema no inference pass over the data is made.

    ``recursive`` walks all folders below ``path`` and takes ``*.json`` files.
    ``with_file`` adds the source file as ``source_file``. ``strict`` stops at a
    line that is no JSON or does not fit the schema; otherwise it gives nulls.
    """
    reader = spark.read.option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    df = reader.json(path if isinstance(path, str) else list(path))
    return df.withColumn("source_file", F.col("_metadata.file_path")) if with_file else df


def scan_csv(
    spark: SparkSession,
    path: Paths,
    schema: StructType | str,
    strict: bool = False,
    mark_bad: bool = False,
    **options,
) -> DataFrame:
    """CSV with a header line in every file.

    ``strict`` stops at a line with too few or too many fields, at a value that
    does not fit its type, and at a header that differs from the schema.
    ``mark_bad`` gives such lines in a column ``_bad_line`` instead, their other
    columns being of no use. With neither they become nulls.
    """
    if strict and mark_bad:
        raise ValueError("bad lines either stop the scan or are marked")
    reader = spark.read.option("header", True).option("escape", '"')
    if strict:
        reader = failing(reader, schema).option("enforceSchema", False)
    else:
        reader = marked(reader, schema) if mark_bad else reader.schema(schema)
    return reader.options(**options).csv(path if isinstance(path, str) else list(path))


def scan_text(spark: SparkSession, path: Paths) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))


def scan_parquet(
    spark: SparkSession,
    path: Paths,
    partitions: Mapping[str, Sequence] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Parquet; ``partitions`` lists the wanted values per partition column.

    The filter is on partition columns, so other folders are never listed or read.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    for name, values in (partitions or {}).items():
        df = df.where(F.col(name).isin(*list(values)))
    return df


def file_manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of every file below ``path``; file content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
