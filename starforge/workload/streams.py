"""Streaming jobs; their drained result equals the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import epoch_ms_to_ts
from ..operators.load import BUCKET, read_upserted
from ..streaming.jobs import file_stream, read_staged, stream_append_new, stream_stage, stream_upsert
from .reading import BAD_LINES_SQL, LOG_SCHEMA, LOG_SQL, _raw_events, lines_with_bad_ones
from .registry import query


def _daily_files(t, events):
    """Events as JSON files, one folder per day."""
    root = t.scratch("stream-source")
    days = events.withColumn("day", F.to_date(epoch_ms_to_ts("ts")))
    days.hint("rebalance", F.col("day")).write.partitionBy("day").json(root)
    return root


def _stream(t, root):
    return file_stream(t.spark, root, LOG_SCHEMA).withColumn("ts", epoch_ms_to_ts("ts"))


@query("stream_stage", LOG_SQL)
def stream_stage_events(t):
    root, target, checkpoint = _daily_files(t, _raw_events(t)), t.scratch("staged"), t.scratch("stage-state")
    stream_stage(_stream(t, root), target, checkpoint)
    stream_stage(_stream(t, root), target, checkpoint)  # nothing new: nothing added
    return t.spark.read.parquet(target)


@query("stream_stage_bad_records", BAD_LINES_SQL)
def stream_stage_bad_records(t):
    """Good rows and bad lines of two rounds of files, each in a table of its own."""
    root, target, bad, checkpoint = (t.scratch(x) for x in ("bad-stream", "bad-staged", "bad-lines", "bad-state"))
    lines = lines_with_bad_ones(t)
    for name, part in (("first", F.col("event_id") % 2 == 0), ("second", F.col("event_id") % 2 == 1)):
        lines.where(part).select("value").write.text(f"{root}/{name}")
        stream = file_stream(t.spark, root, "event_id long, event_type string", mark_bad=True, pathGlobFilter="part-*")
        stream_stage(stream, target, checkpoint, bad_records=bad)
    staged = read_staged(t.spark, target).withColumn("bad_line", F.lit(None).cast("string"))
    return staged.unionByName(read_staged(t.spark, bad, "text").withColumnRenamed("value", "bad_line"), True)


@query("stream_append_new", LOG_SQL)
def stream_append_new_events(t):
    """Purchases are sent twice, the second time days later."""
    raw = _raw_events(t)
    resent = raw.where(F.col("event_type") == "purchase")
    root = _daily_files(t, raw.unionByName(resent))
    target = t.scratch("appended")
    stream_append_new(
        _stream(t, root), target, ["user_id", "event_id", "ts"], t.scratch("append-state"),
        order_by=["event_type"], between=["ts"],
    )
    return t.spark.read.parquet(target).select("event_id", "ts", "user_id", "event_type", "value", "props")


@query(
    "stream_upsert_latest",
    """SELECT DISTINCT ON (user_id) user_id, event_type, value, date_trunc('milliseconds', ts) AS ts FROM events
       ORDER BY user_id, date_trunc('milliseconds', ts) DESC, event_id DESC""",
)
def stream_upsert_latest(t):
    root, target = _daily_files(t, _raw_events(t)), t.scratch("profiles")
    stream = _stream(t, root).select("user_id", "event_type", "value", "ts", "event_id")
    stream_upsert(stream, target, ["user_id"], ["ts", "event_id"], t.scratch("upsert-state"), buckets=32)
    return read_upserted(t.spark, target).drop(BUCKET, "event_id")
