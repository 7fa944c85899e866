"""Table loads on plain Parquet: truncate, append, insert-ignore, append-new, upsert.

A load that failed may be repeated: ``append_new``, ``insert_ignore`` and ``upsert``
compare keys with what the target already holds, ``truncate_load`` replaces it.
``append_only`` adds its rows once more each time it is run.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import materialise, path_exists
from ..sources.staging import check_mode
from ..sources.writers import write_parquet
from .joins import anti, first_per_key, latest_by

BUCKET = "key_bucket"


class LoadStats(NamedTuple):
    """Row counts of a load; None where the caller asked not to count."""

    before: int | None
    after: int | None
    inserted: int | None


# Beside the data files, not seen by readers: the rows that the last load left.
ROWS_FILE = "_rows"


def _file(spark: SparkSession, path: str):
    """File system and Hadoop path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _content(spark: SparkSession, target: str) -> list[int]:
    """Number and bytes of a table's files, but for the note of its rows."""
    fs, path = _file(spark, target)
    whole = fs.getContentSummary(path)
    note = _file(spark, f"{target}/{ROWS_FILE}")[1]
    own = [1, fs.getFileStatus(note).getLen()] if fs.exists(note) else [0, 0]
    return [whole.getFileCount() - own[0], whole.getLength() - own[1]]


def note_rows(spark: SparkSession, target: str, rows: int) -> None:
    """Note how many rows a load left, with the files that it left."""
    fs, path = _file(spark, f"{target}/{ROWS_FILE}")
    text = json.dumps({"rows": rows, "content": _content(spark, target)})
    out = fs.create(path, True)
    out.write(bytearray(text.encode()))
    out.close()


def noted_rows(spark: SparkSession, target: str) -> int | None:
    """The noted rows, if the table's files are still those of the note."""
    fs, path = _file(spark, f"{target}/{ROWS_FILE}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        note = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return note["rows"] if note["content"] == _content(spark, target) else None


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table: as the last load noted them, or from the file
    footers where something else has changed the files; 0 when it is not there."""
    if not path_exists(spark, path):
        return 0
    noted = noted_rows(spark, path)
    return spark.read.parquet(path).count() if noted is None else noted


def write_counted(df: DataFrame, target: str, partition_by: Sequence[str], mode: str, dealt: bool = False) -> int:
    """Write, and return the number of rows written, observed by the write itself."""
    seen = Observation()
    write_parquet(df, target, partition_by, mode=mode, counted=seen, dealt=dealt)
    return seen.get["rows"]


def read_target(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The target, or no rows of that schema before the first load."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _write(
    df: DataFrame, target: str, partition_by: Sequence[str], mode: str, before: int | None, dealt: bool = False
) -> LoadStats:
    """Write and count; ``before`` is None where the caller asked not to count."""
    if before is None:
        write_parquet(df, target, partition_by, mode=mode, dealt=dealt)
        return LoadStats(None, None, None)
    written = write_counted(df, target, partition_by, mode, dealt)
    after = written if mode == "overwrite" else before + written
    note_rows(df.sparkSession, target, after)
    return LoadStats(before, after, written)


def load(df: DataFrame, target: str, mode: str, partition_by: Sequence[str] = (), dealt: bool = False) -> LoadStats:
    """Truncate-and-load or append, with row counts that the write takes itself.
    ``dealt``: the rows are with their partition already (``writers.deal``)."""
    check_mode(mode)
    before = row_count(df.sparkSession, target)
    return _write(df, target, partition_by, "overwrite" if mode == "truncate_load" else "append", before, dealt)


def replace_partitions(df: DataFrame, target: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows for, by one write.

    The other partitions keep their files, which are neither read nor listed. A
    load that is repeated gives the same table, so slices (months, files) can be
    loaded together and again. A partition that gets no row stays: to empty one,
    drop its folder. The job stages its files and moves them at its commit, so a
    job that fails before leaves the table as it was.
    """
    if not partition_by:
        raise ValueError("partitions can only be replaced in a partitioned table")
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(target)


def insert_ignore(
    target: str,
    batch: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    counted: bool = True,
) -> LoadStats:
    """Insert rows with an unknown key; inside the batch the first in order wins."""
    return append_new(target, batch, key, order_by, partition_by, counted=counted)


def append_new(
    target: str,
    batch: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    between: Sequence[str] = (),
    counted: bool = True,
    unique: bool = False,
    dealt: bool = False,
) -> LoadStats:
    """Append the rows whose natural key the target does not hold yet.

    ``between`` names columns that belong to the key or follow from it (event
    time, its year). The target scan is limited to the batch's range on them, so
    an hourly batch does not read all of history: folders and row groups outside
    the range are skipped. The reduced batch is then written once to the shared
    folder, since both the range and the comparison need it.
    ``counted=False`` skips the row counts: those of the write, and the note that
    it leaves for the next load. ``unique`` says that no two rows of the batch
    have one key, which saves the reduction; ``dealt`` that they are with their
    partition already, which holds for a first load only.
    """
    spark = batch.sparkSession
    order = list(order_by or [c for c in batch.columns if c not in key] or key)
    fresh = batch if unique else first_per_key(batch, key, order).select(*batch.columns)
    if not path_exists(spark, target):
        return _write(fresh, target, partition_by, "append", 0 if counted else None, dealt and unique)
    before = row_count(spark, target) if counted else None
    known = read_target(spark, target, batch.schema)
    if between:
        fresh = materialise(fresh, "append-batch")
        ends = fresh.agg(*[f(c).alias(f"{n}_{c}") for c in between for n, f in (("lo", F.min), ("hi", F.max))])
        row = ends.first()
        for c in between:
            lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
            if lo is not None:
                known = known.where(F.col(c).between(lo, hi) | F.col(c).isNull())
    return _write(anti(fresh, known, list(key)), target, partition_by, "append", before)


def key_bucket(key: Sequence[str], buckets: int) -> Column:
    """Folder number of a key; it never changes, so an upsert stays inside its folder."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _versions(spark: SparkSession, target: str) -> tuple[int, dict[int, int]]:
    """The number of the last published state, and the version of each folder in
    it (one entry per folder). A state is published by the success marker of its
    listing, written last."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_states")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0, {}
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    for n in sorted((int(x) for x in names if x.isdigit()), reverse=True):
        if path_exists(spark, f"{target}/_states/{n}/_SUCCESS"):
            rows = spark.read.schema("folder int, version int").json(f"{target}/_states/{n}").collect()
            return n, {r["folder"]: r["version"] for r in rows}
    return 0, {}


def read_upserted(spark: SparkSession, target: str, folders: Sequence[int] | None = None) -> DataFrame | None:
    """The rows of a table kept by ``upsert``, as of the last published state;
    None before the first one. ``folders`` reads only those."""
    _, versions = _versions(spark, target)
    wanted = sorted(versions if folders is None else set(folders) & set(versions))
    if not wanted:
        return None
    paths = [f"{target}/version={versions[f]}/{BUCKET}={f}" for f in wanted]
    return spark.read.option("basePath", target).parquet(*paths).drop("version")


def upsert(
    target: str,
    batch: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str | Column],
    buckets: int,
    counted: bool = True,
) -> LoadStats:
    """Insert new keys and replace known ones; the row that is last in order wins.

    The table is laid out in ``buckets`` hash folders of the key, a number that
    stays for the life of the table. Only the folders that the batch touches are
    read, merged by (folder, key) over all tasks, and written beside the old
    ones under a new version; a listing of the folders' versions publishes them.
    What is read is never overwritten, and a load that died leaves the last
    state as it was. One writer at a time. An older row that arrives late does
    not replace a newer one; on equal order the batch wins. Read the table with
    ``read_upserted``; ``drop_superseded`` frees what no reader needs any more.
    """
    spark = batch.sparkSession
    # Reduce the batch first: a key sent a million times becomes one row here.
    newest = latest_by(batch, key, order_by).select(*batch.columns)
    newest = materialise(newest.withColumn(BUCKET, key_bucket(key, buckets)), "upsert-batch")
    state, versions = _versions(spark, target)
    known = read_upserted(spark, target)
    before = (0 if known is None else known.count()) if counted else None
    # At most `buckets` values.
    touched = [r[0] for r in newest.select(BUCKET).distinct().collect()]
    old = read_upserted(spark, target, touched)
    merged = newest
    if old is not None:
        both = old.select(*newest.columns).withColumn("_new", F.lit(0)).unionByName(newest.withColumn("_new", F.lit(1)))
        order = [F.col(c) if isinstance(c, str) else c for c in order_by]
        merged = latest_by(both, [BUCKET, *key], [*order, F.col("_new")]).select(*newest.columns)
    if touched:
        write_parquet(merged, f"{target}/version={state + 1}", [BUCKET])
        rows = {**versions, **{f: state + 1 for f in touched}}
        listing = spark.createDataFrame(sorted(rows.items()), "folder int, version int")
        listing.coalesce(1).write.mode("overwrite").json(f"{target}/_states/{state + 1}")
    if before is None:
        return LoadStats(None, None, None)
    after = read_upserted(spark, target)
    n = 0 if after is None else after.count()
    return LoadStats(before, n, n - before)


def drop_superseded(spark: SparkSession, target: str) -> list[str]:
    """Delete the folders that the last state does not list, and the listings of
    the states before it; for when no reader is at work. Returns the folders."""
    state, versions = _versions(spark, target)
    kept = {f"version={v}/{BUCKET}={f}" for f, v in versions.items()}
    root = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for version in fs.listStatus(root):
        if version.getPath().getName().startswith("version="):
            for folder in fs.listStatus(version.getPath()):
                name = f"{version.getPath().getName()}/{folder.getPath().getName()}"
                if folder.isDirectory() and name not in kept:
                    fs.delete(folder.getPath(), True)
                    dropped.append(name)
    listings = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_states")
    for listing in fs.listStatus(listings) if fs.exists(listings) else []:
        if listing.getPath().getName() != str(state):
            fs.delete(listing.getPath(), True)
    return sorted(dropped)


def stats_frame(spark: SparkSession, stats: Mapping[str, LoadStats]) -> DataFrame:
    """Load counts as rows: step, before, after, inserted."""
    rows = [
        F.struct(
            F.lit(name).alias("step"),
            *[F.lit(n).cast("long").alias(field) for field, n in zip(LoadStats._fields, s)],
        )
        for name, s in stats.items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))
