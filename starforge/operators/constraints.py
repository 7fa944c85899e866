"""NOT NULL and PRIMARY KEY, checked by the job that writes the rows.

The checks are part of the written columns, so a row that breaks one fails its
task and the job is aborted before it commits: nothing of the load is seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import path_exists, scratch_path
from ..sources.staging import check_mode
from ..sources.tables import table_constraints
from ..sources.writers import write_parquet

_COPIES, _NEW = "_copies", "_new"


def _raised(message: str, kind) -> Column:
    return F.raise_error(F.lit(message)).cast(kind)


def with_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df``, reading which fails at a null in one of the columns."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    checks = {c: F.coalesce(F.col(c), _raised(f"NOT NULL is broken by a null in {c}", kinds[c])) for c in columns}
    return df.withColumns(checks)


def with_unique_key(df: DataFrame, key: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """``df``, reading which fails if two rows share a key, or one shares it with
    ``known``. Rows and known keys are shuffled once, by the key; keys with a null
    are not compared, ``with_not_null`` refuses them."""
    rows = df.withColumn(_NEW, F.lit(True))
    if known is not None:
        rows = rows.unionByName(known.select(*key).withColumn(_NEW, F.lit(False)), allowMissingColumns=True)
    copies = rows.withColumn(_COPIES, F.count(F.lit(1)).over(Window.partitionBy(*key)))
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
    message = f"PRIMARY KEY ({', '.join(key)}) is broken by a repeated key"
    first, kind = key[0], df.schema[key[0]].dataType
    checked = F.when(whole & (F.col(_COPIES) > 1), _raised(message, kind)).otherwise(F.col(first))
    return copies.where(_NEW).withColumn(first, checked).select(*df.columns)


def constrained(
    df: DataFrame, not_null: Sequence[str] = (), primary_key: Sequence[str] = (), known: DataFrame | None = None
) -> DataFrame:
    """``df`` with both checks; a primary key takes no nulls."""
    out = with_unique_key(df, primary_key, known) if primary_key else df
    return with_not_null(out, list(dict.fromkeys([*not_null, *primary_key])))


def replace_folder(spark: SparkSession, new: str, target: str) -> None:
    """Put the folder ``new`` in the place of ``target``, by renames on one file
    system. If the second rename is refused the old folder is put back."""
    if not path_exists(spark, new):
        raise FileNotFoundError(new)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    old = path(f"{target}.replaced")
    if fs.exists(path(target)):
        fs.delete(old, True)
        if not fs.rename(path(target), old):
            raise OSError(f"{target} could not be set aside")
    else:
        fs.mkdirs(path(target).getParent())
    if not fs.rename(path(new), path(target)):
        fs.rename(old, path(target))
        raise OSError(f"{new} could not be put in place of {target}")
    fs.delete(old, True)


def load_constrained(
    df: DataFrame,
    target: str,
    mode: str,
    not_null: Sequence[str] = (),
    primary_key: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """Truncate-and-load or append; a load that breaks a constraint fails and
    leaves the target as it was.

    An append compares its keys with those of the target. A replacement is
    written beside the target and takes its place when it is whole; both must be
    on one file system.
    """
    check_mode(mode)
    spark = df.sparkSession
    if mode == "append_only":
        known = spark.read.schema(df.schema).parquet(target) if path_exists(spark, target) else None
        write_parquet(constrained(df, not_null, primary_key, known), target, partition_by, mode="append")
        return
    beside = f"{target}.incoming"
    write_parquet(constrained(df, not_null, primary_key), beside, partition_by)
    replace_folder(spark, beside, target)


def load_table(df: DataFrame, name: str, mode: str) -> None:
    """Truncate-and-load or append a catalogue table under the constraints that it
    was created with. Columns are taken by name."""
    check_mode(mode)
    spark = df.sparkSession
    not_null, key = table_constraints(spark, name)
    table = spark.table(name)
    rows = df.select(*table.columns)
    if mode == "append_only":
        constrained(rows, not_null, key, table if key else None).write.insertInto(name)
        return
    # INSERT OVERWRITE empties the table before its job runs, so the rows are checked and written aside first.
    aside = scratch_path(spark, "constrained")
    write_parquet(constrained(rows, not_null, key), aside)
    spark.read.schema(rows.schema).parquet(aside).write.insertInto(name, overwrite=True)
