"""Incremental loads as drain-and-stop Structured Streaming jobs.

Lines that do not fit the schema stop a job, or are kept apart: a stream opened
with ``mark_bad`` carries them in ``_bad_line``, and the jobs then write them to
``bad_records``, one folder per micro-batch. A micro-batch that is run again
after a failure replaces its folders.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.load import append_new, upsert
from ..sources.rejects import failing, is_marked, judged_once, marked
from ..sources.writers import write_parquet, write_text

LOAD = "load"


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "json",
    files_per_trigger: int | None = None,
    mark_bad: bool = False,
    **options,
) -> DataFrame:
    """New files below ``path`` as a stream. A line that does not fit the schema
    stops the job, or with ``mark_bad`` has its text in the column ``_bad_line``."""
    reader = spark.readStream.option("recursiveFileLookup", True).options(**options)
    reader = (marked if mark_bad else failing)(reader, schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def _drain(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def _batch_folder(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Folder of a micro-batch: the stream's own id, which its checkpoint keeps
    over restarts, and the number of the batch."""
    stream_id = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    return f"{LOAD}={stream_id}_{batch_id}"


def _check_sinks(stream: DataFrame, bad_records: str | None) -> None:
    if is_marked(stream) != (bad_records is not None):
        raise ValueError("bad_records goes with a stream opened with mark_bad")


def _each_batch(
    stream: DataFrame, checkpoint: str, bad_records: str | None, take: Callable[[DataFrame, str], None]
) -> StreamingQuery:
    """Run ``take(good rows, folder of the batch)`` on every micro-batch, after
    its bad lines have been written."""
    _check_sinks(stream, bad_records)

    def step(batch: DataFrame, batch_id: int) -> None:
        folder = _batch_folder(batch.sparkSession, checkpoint, batch_id)
        if bad_records is None:
            take(batch, folder)
            return
        with judged_once(batch) as (good, bad):
            write_text(bad, f"{bad_records}/{folder}")
            take(good, folder)

    return _drain(
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_stage(stream: DataFrame, target: str, checkpoint: str, bad_records: str | None = None) -> StreamingQuery:
    """Append every file exactly once to a Parquet staging table, then stop.

    A restart with the same checkpoint takes up only the files that are new.
    With ``bad_records`` good rows and bad lines have a folder per micro-batch
    each, ``load=<stream>_<batch>``; read them with ``read_staged``.
    """
    _check_sinks(stream, bad_records)
    if bad_records is not None:
        return _each_batch(
            stream, checkpoint, bad_records, lambda good, folder: write_parquet(good, f"{target}/{folder}")
        )
    return _drain(
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )


def read_staged(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """What ``stream_stage`` kept in folders per micro-batch; ``fmt="text"`` for bad lines."""
    return spark.read.format(fmt).load(target).drop(LOAD)


def stream_append_new(
    stream: DataFrame,
    target: str,
    key: Sequence[str],
    checkpoint: str,
    order_by: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    between: Sequence[str] = (),
    bad_records: str | None = None,
) -> StreamingQuery:
    """Idempotent fact append.

    Every micro-batch is reduced to one row per key and compared with the target
    before it is appended. That covers re-sent rows of any age as well as a
    micro-batch that is run again after a failure. No watermark is set: it would
    discard rows that arrive late, and the comparison needs no state to expire.
    """

    def append(batch: DataFrame, _: str) -> None:
        append_new(target, batch, key, order_by, partition_by, between, counted=False)

    return _each_batch(stream, checkpoint, bad_records, append)


def stream_upsert(
    stream: DataFrame,
    target: str,
    key: Sequence[str],
    order_by: Sequence[str | Column],
    checkpoint: str,
    buckets: int,
    bad_records: str | None = None,
) -> StreamingQuery:
    """Keep the latest row per key. Ordered by event time, so neither the order
    of micro-batches nor a repeated one changes the outcome."""

    def merge(batch: DataFrame, _: str) -> None:
        if not batch.isEmpty():
            upsert(target, batch, key, order_by, buckets, counted=False)

    return _each_batch(stream, checkpoint, bad_records, merge)
