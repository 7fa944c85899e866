"""Projection, renaming, filtering and filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.predicates import is_blank


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def restage(df: DataFrame, old: str, new: str) -> DataFrame:
    """Swap a lineage prefix on every column that carries it."""
    return df.withColumnsRenamed(
        {c: new + c[len(old):] for c in df.columns if c.startswith(old)}
    )


def except_cols(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def with_key(df: DataFrame, key: str, source: str) -> DataFrame:
    """Use a business key as the surrogate key."""
    return df.withColumn(key, F.col(source))


def drop_empty(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows in which every named column holds a value."""
    out = df
    for name in columns:
        out = out.where(~is_blank(name))
    return out


def lookup(df: DataFrame, **key) -> DataFrame:
    """Rows of one composite key; prunes partitions where the key is the layout."""
    out = df
    for name, value in key.items():
        out = out.where(F.col(name) == F.lit(value))
    return out


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def mismatches(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows in which two columns that should agree do not."""
    return df.where(F.col(left) != F.col(right))


def clustered(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Lay rows out for lookups by ``partition``, ordered by ``order`` inside it.

    Range partitioning on both lists lets one large partition key span several
    tasks; a key's rows stay contiguous and ordered.
    """
    return df.repartitionByRange(*partition, *order).sortWithinPartitions(*partition, *order)


def default_member(df: DataFrame, member: Mapping[str, object]) -> DataFrame:
    """Add one default row; columns it does not name are null."""
    row = df.sparkSession.range(1).select(
        *[F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row)
