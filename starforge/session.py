"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Every timestamp rule in this package is stated in UTC.
    "spark.sql.session.timeZone": "UTC",
    # AQE resizes shuffles, turns joins into broadcasts once a side is known to
    # be small, and splits a hot partition of a sort-merge join.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# For work on tables of any size: what one task reads is bounded, so that its sorts
# and hash tables are too and do not spill. Narrow rows compress well: 8 MB of a
# shuffle may be a million rows.
TASK_SETTINGS = {
    # Shuffles start with many partitions, which AQE puts together by size; up to
    # 200 they are written without a sort.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "32m",
}

# For loads that write much: what they leave on disk at any time.
LOAD_SETTINGS = {
    # The shuffle files of a query go when it ends, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def sparing_disk(spark: SparkSession):
    """``LOAD_SETTINGS`` while a load runs; the session's own hold again afterwards."""
    before = {key: spark.conf.get(key, None) for key in LOAD_SETTINGS}
    for key, value in LOAD_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators count on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def configure_tables(spark: SparkSession) -> SparkSession:
    """The same with bounds on what one task reads, for loads and queries of tables."""
    for key, value in TASK_SETTINGS.items():
        configure(spark).conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is missing it must be named first: a machine-local folder
    would not be visible to the executors of a cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def name_shared_dir(spark: SparkSession) -> None:
    """For the outermost caller: where no shared folder is named and all executors
    run in this process, name a temporary one. On a cluster nothing is done."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starforge-"))


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{shared_dir(spark)}/starforge/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call returns."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Drop what this application wrote to its scratch folder; for its very end.

    DataFrames that read materialised rows are of no use afterwards.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    Cuts lineage with a real table, so a lost executor re-reads a file instead
    of recomputing (and perhaps reordering) the rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._materialised_at = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialise`` wrote for these, once no plan reads them any more."""
    for df in tables:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._materialised_at)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the file system its scheme names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))
