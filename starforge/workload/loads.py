"""Load semantics: every query runs its loads more than once where that is the point."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import constraints, load
from ..operators.load import stats_frame
from ..operators.joins import referenced_only
from ..operators.quality import DataQualityError
from ..plans.publish import STAR_RULES, load_audited_star
from ..plans.staged_load import KEY_COLUMNS, load_songplay_star
from ..sources import tables
from ..session import materialise, sparing_disk
from .raw import SONGPLAYS_SQL, catalogue, event_log
from .registry import query


@query("load_truncate", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def load_truncate(t):
    target, rows = t.scratch("load-truncate"), t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    load.load(rows, target, "truncate_load")
    load.load(rows, target, "truncate_load")
    return t.spark.read.parquet(target)


@query("load_append", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def load_append(t):
    target, rows = t.scratch("load-append"), t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    load.load(rows.where(F.col("o_orderstatus") == "F"), target, "append_only")
    load.load(rows.where(F.col("o_orderstatus") != "F"), target, "append_only")
    return t.spark.read.parquet(target)


@query(
    "insert_ignore",
    """SELECT DISTINCT ON (user_id) user_id, event_type, ts FROM events
       ORDER BY user_id, CASE WHEN event_type = 'signup' THEN 1 ELSE 2 END, ts, event_id""",
)
def insert_ignore(t):
    """Sign-ups come first; later events of known users are ignored."""
    target = t.scratch("insert-ignore")
    rows = t.events.select("user_id", "event_type", "ts", "event_id")
    signups = rows.where(F.col("event_type") == "signup")
    others = rows.where(F.col("event_type") != "signup")
    for batch in (signups, others, signups):
        load.insert_ignore(target, batch, ["user_id"], ["ts", "event_id"], counted=False)
    return t.spark.read.parquet(target).drop("event_id")


@query(
    "upsert_last_wins",
    """SELECT DISTINCT ON (user_id) user_id, event_type, value, ts FROM events
       ORDER BY user_id, ts DESC, event_id DESC""",
)
def upsert_last_wins(t):
    """Three batches out of order: an older row does not replace a newer one."""
    target = t.scratch("upsert")
    rows = t.events.select("user_id", "event_type", "value", "ts", "event_id")
    for kinds in (["purchase", "view"], ["click", "error"], ["signup"]):
        batch = rows.where(F.col("event_type").isin(kinds))
        load.upsert(target, batch, ["user_id"], ["ts", "event_id"], buckets=32, counted=False)
    return load.read_upserted(t.spark, target).drop(load.BUCKET, "event_id")


@query(
    "append_new_facts",
    "SELECT event_id, user_id, event_type, ts, CAST(ts AS DATE) AS day FROM events",
)
def append_new_facts(t):
    """Overlapping batches: rows that were loaded before are not loaded again."""
    target = t.scratch("append-new")
    rows = t.events.select("event_id", "user_id", "event_type", "ts", F.to_date("ts").alias("day"))
    first = rows.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    later = rows.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    for batch in (first, later, later):
        load.append_new(
            target, batch, ["user_id", "ts", "event_id"],
            partition_by=["day"], between=["day", "ts"], counted=False,
        )
    return t.spark.read.parquet(target)


@query(
    "append_new_members",
    """SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""",
)
def append_new_members(t):
    """Dimension members as the fact starts to refer to them."""
    target = t.scratch("append-members")
    parts = t.part.select("p_partkey", "p_name", "p_brand")
    for facts in (t.lineitem.where(F.col("l_returnflag") == "R"), t.lineitem):
        members = referenced_only(parts, facts, {"p_partkey": "l_partkey"})
        load.append_new(target, members, ["p_partkey"], counted=False)
    return t.spark.read.parquet(target)


@query(
    "replace_partitions",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) % 2 = 0 THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS price,
              CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
)
def replace_partitions(t):
    """Corrected prices for every second year, loaded twice, replace its months only."""
    target = t.scratch("replaced")
    year, month = F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"), year, month)
    corrected = rows.where(F.col("year") % 2 == 0).withColumn("price", F.round(F.col("price") * 2, 2))
    for batch in (rows, corrected, corrected):
        load.replace_partitions(batch, target, ["year", "month"])
    return t.spark.read.parquet(target)


def _refused(step):
    """Run a load that a constraint has to stop."""
    try:
        step()
    except Exception as error:  # noqa: BLE001 - what Spark raises depends on the session
        if "is broken by" not in str(error):
            raise
        return
    raise RuntimeError("a load that breaks a constraint went through")


@query("load_constrained", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def load_constrained(t):
    """Appends under NOT NULL and a primary key. Loads with a null, with a key
    twice and with a known key fail; what they left is the result."""
    target = t.scratch("constrained")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")

    def add(batch, mode="append_only"):
        constraints.load_constrained(batch, target, mode, ["o_custkey"], ["o_orderkey"])

    add(rows.where(F.col("o_orderkey") % 2 == 0))
    later = rows.where(F.col("o_orderkey") % 2 == 1)
    no_customer = later.withColumn("o_custkey", F.when(F.col("o_totalprice") < 100_000, F.col("o_custkey")))
    _refused(lambda: add(no_customer))
    _refused(lambda: add(later.unionByName(later)))
    _refused(lambda: add(rows))
    _refused(lambda: add(no_customer, "truncate_load"))
    add(later)
    return t.spark.read.parquet(target)


@query("load_constrained_table", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def load_constrained_table(t):
    """The same for a catalogue table, by the constraints that it was created with."""
    path = t.scratch("constrained-table")
    name = f"constrained_{path[-32:]}"
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey")
    tables.ensure_table(
        t.spark, name, "c_custkey long, c_name string NOT NULL, c_nationkey long", path, primary_key=["c_custkey"]
    )
    constraints.load_table(rows.where(F.col("c_nationkey") < 10), name, "append_only")
    rest = rows.where(F.col("c_nationkey") >= 10)
    _refused(lambda: constraints.load_table(rows, name, "append_only"))
    _refused(lambda: constraints.load_table(rest.withColumn("c_name", F.nullif("c_name", "c_name")), name, "append_only"))
    _refused(lambda: constraints.load_table(rest.unionByName(rest), name, "truncate_load"))
    constraints.load_table(rest, name, "append_only")
    return t.spark.table(name)


@query(
    "load_stats",
    """SELECT 'first' AS step, 0 AS before, count(*) FILTER (WHERE o_orderstatus <> 'P') AS after,
              count(*) FILTER (WHERE o_orderstatus <> 'P') AS inserted FROM orders
       UNION ALL
       SELECT 'all', count(*) FILTER (WHERE o_orderstatus <> 'P'), count(*),
              count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders
       UNION ALL
       SELECT 'again', count(*), count(*), 0 FROM orders""",
)
def load_stats(t):
    target, stats = t.scratch("load-stats"), {}
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    batches = {"first": rows.where(F.col("o_orderstatus") != "P"), "all": rows, "again": rows}
    for step, batch in batches.items():
        stats[step] = load.append_new(target, batch, ["o_orderkey"])
    return stats_frame(t.spark, stats)


STAR_LOAD_SQL = f"""
WITH {SONGPLAYS_SQL}
SELECT step, CAST(0 AS BIGINT) AS before, n AS after, n AS inserted FROM (
  SELECT 'staging_events' AS step, count(*) AS n FROM event_log
  UNION ALL SELECT 'staging_songs', count(*) FROM catalogue
  UNION ALL SELECT 'f_songplays', count(*) FROM songplays
  UNION ALL SELECT 'd_users', count(DISTINCT userId) FROM event_log WHERE page = 'NextSong'
  UNION ALL SELECT 'd_songs', count(DISTINCT song_id) FROM catalogue
  UNION ALL SELECT 'd_artists', count(DISTINCT artist_id) FROM catalogue
  UNION ALL SELECT 'd_time', count(DISTINCT ts) FROM event_log WHERE page = 'NextSong')
"""


def _loaded_star(t):
    return load_songplay_star(event_log(t), catalogue(t), t.scratch("songplay-star"))


@query("staged_star_load", STAR_LOAD_SQL)
def staged_star_load(t):
    counts, _ = _loaded_star(t)
    return counts


@query(
    "staged_star_report",
    STAR_LOAD_SQL.replace(
        "SELECT step, CAST(0 AS BIGINT) AS before, n AS after, n AS inserted FROM (",
        "SELECT step AS table_name, 0 AS null_entries, n AS entries, 'OK' AS status FROM (",
    ).rstrip()
    + " WHERE step NOT LIKE 'staging%'",
)
def staged_star_report(t):
    """The quality report of a load of its own."""
    _, report = _loaded_star(t)
    return report


@query(
    "staged_star_audited",
    STAR_LOAD_SQL.replace(
        "SELECT step, CAST(0 AS BIGINT) AS before, n AS after, n AS inserted FROM (",
        "SELECT step AS table_name, n AS entries FROM (",
    ).rstrip()
    + " WHERE step NOT LIKE 'staging%'",
)
def staged_star_audited(t):
    """A second load whose plays lack their level fails its check: readers still
    see the first one whole."""
    root = t.scratch("audited-star")
    prefix = f"star_{root[-32:]}_"
    with sparing_disk(t.spark):
        log = materialise(event_log(t), "event-log")
        songs = materialise(catalogue(t), "catalogue")
    load_audited_star(log, songs, root, "first", prefix, STAR_RULES)
    try:
        load_audited_star(log.withColumn("level", F.lit(None).cast("string")), songs, root, "second", prefix, STAR_RULES)
    except DataQualityError:
        pass
    else:
        raise RuntimeError("plays without a level were published")
    counts = [
        t.spark.table(prefix + name).agg(F.count(F.lit(1)).alias("entries")).select(F.lit(name).alias("table_name"), "entries")
        for name in KEY_COLUMNS
    ]
    return reduce(DataFrame.unionByName, counts)
