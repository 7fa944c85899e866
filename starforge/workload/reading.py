"""Sources and sinks: every query writes a whole table and reads it back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import sources
from ..functions.dates import epoch_ms_to_ts
from ..plans.catalog import Catalog
from .registry import query

LOG_SCHEMA = "event_id long, ts long, user_id long, event_type string, value double, props string"
LOG_SQL = """SELECT event_id, date_trunc('milliseconds', ts) AS ts, user_id, event_type, value, props FROM events"""


def _raw_events(t):
    """Events as a log has them: the time is epoch milliseconds."""
    return t.events.withColumn("ts", F.unix_millis(F.col("ts").cast("timestamp")))


@query("scan_json", LOG_SQL)
def scan_json(t):
    path = sources.write_json(_raw_events(t), t.scratch("scan-json"))
    return sources.scan_json(t.spark, path, LOG_SCHEMA).withColumn("ts", epoch_ms_to_ts("ts"))


@query(
    "scan_json_nested",
    """SELECT c_mktsegment AS segment, n_name AS nation, count(*) AS entries,
              round(sum(c_acctbal), 2) AS balance
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def scan_json_nested(t):
    nested = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.struct("c_mktsegment", "c_acctbal", F.struct("n_name").alias("place")).alias("fields")
    )
    path = sources.write_json(nested, t.scratch("scan-json-nested"))
    return (
        sources.scan_json(t.spark, path)
        .groupBy(F.col("fields.c_mktsegment").alias("segment"), F.col("fields.place.n_name").alias("nation"))
        .agg(F.count(F.lit(1)).alias("entries"), F.round(F.sum("fields.c_acctbal"), 2).alias("balance"))
    )


@query(
    "scan_recursive",
    "SELECT p_partkey, p_name, p_size, p_type AS folder FROM part",
)
def scan_recursive(t):
    root = t.scratch("scan-recursive")
    rows = t.part.select("p_partkey", "p_name", "p_size", "p_type")
    rows.write.partitionBy("p_type").json(f"{root}/a/b")
    found = sources.scan_json(
        t.spark, root, "p_partkey long, p_name string, p_size int", recursive=True, with_file=True
    )
    folder = F.regexp_extract("source_file", "p_type=([A-Z]+)/", 1)
    return found.withColumn("folder", folder).drop("source_file")


@query(
    "stage_json_paths",
    """SELECT event_id, event_type AS page, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
)
def stage_json_paths(t):
    nested = t.events.select(
        F.struct("event_id", "event_type").alias("meta"), F.from_json("props", "k int").alias("props")
    )
    path = sources.write_json(nested, t.scratch("json-paths"))
    return sources.stage_json(
        t.spark,
        path,
        t.scratch("json-paths-staged"),
        mapping={
            "event_id": ("$.meta.event_id", "bigint"),
            "page": ("$.meta.event_type", "string"),
            "k": ("$.props.k", "int"),
        },
    )


@query(
    "stage_json_bracket_paths",
    """SELECT event_id, event_type AS page, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value AS first
       FROM events""",
)
def stage_json_bracket_paths(t):
    """Bracket notation, a name with a dot, an array element."""
    nested = t.events.select(
        F.struct("event_id", F.col("event_type").alias("event.type")).alias("meta"),
        F.from_json("props", "k int").alias("the props"),
        F.array("value", F.col("event_id").cast("double")).alias("figures"),
    )
    path = sources.write_json(nested, t.scratch("json-brackets"))
    return sources.stage_json(
        t.spark,
        path,
        t.scratch("json-brackets-staged"),
        mapping={
            "event_id": ("$['meta'].event_id", "bigint"),
            "page": ("$['meta'][\"event.type\"]", "string"),
            "k": ("$['the props']['k']", "int"),
            "first": ("$.figures[0]", "double"),
        },
    )


# Events of two kinds are bad lines: an ill-typed value, a second opening brace.
BAD_LINES_SQL = """
SELECT CASE WHEN event_type NOT IN ('error', 'signup') THEN event_id END AS event_id,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN event_type END AS event_type,
       CASE event_type WHEN 'error' THEN '{{"event_id":' || event_id || ',"event_type":"error"}'
                       WHEN 'signup' THEN '{"event_id": "none", "event_type": "signup"}' END AS bad_line
FROM events"""


def lines_with_bad_ones(t):
    """``event_id`` and the line (``value``) of every event."""
    line = F.to_json(F.struct("event_id", "event_type"))
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("{"), line))
    ill = F.concat(F.lit('{"event_id": "none", "event_type": "'), "event_type", F.lit('"}'))
    return t.events.select(
        "event_id", broken.when(F.col("event_type") == "signup", ill).otherwise(line).alias("value")
    )


@query("stage_json_bad_records", BAD_LINES_SQL)
def stage_json_bad_records(t):
    """Broken lines and ill-typed values go to a folder of their own, the rest is
    loaded; two loads add to both."""
    target, bad = t.scratch("bad-staged"), t.scratch("bad-lines")
    lines = lines_with_bad_ones(t)
    for name, part in (("even", F.col("event_id") % 2 == 0), ("odd", F.col("event_id") % 2 == 1)):
        path = sources.write_text(lines.where(part).select("value"), t.scratch(f"bad-source-{name}"))
        staged = sources.stage_json(
            t.spark, path, target, schema="event_id long, event_type string", mode="append_only", bad_records=bad
        )
    rejects = sources.scan_text(t.spark, bad).withColumnRenamed("value", "bad_line")
    return staged.unionByName(rejects, allowMissingColumns=True)


@query(
    "stage_csv_bad_records",
    """SELECT CASE WHEN p_size % 7 > 1 THEN p_partkey END AS p_partkey, CASE WHEN p_size % 7 > 1 THEN p_brand END AS p_brand,
              CASE WHEN p_size % 7 > 1 THEN p_size END AS p_size,
              CASE WHEN p_size % 7 = 0 THEN p_partkey || ',' || p_brand
                   WHEN p_size % 7 = 1 THEN p_partkey || ',' || p_brand || ',size ' || p_size END AS bad_line
       FROM part""",
)
def stage_csv_bad_records(t):
    """Lines without their last field, and sizes that are no numbers, among those of a catalogue."""
    size = F.when(F.col("p_size") % 7 == 1, F.concat(F.lit(",size "), "p_size"))
    size = size.when(F.col("p_size") % 7 == 0, "").otherwise(F.concat(F.lit(","), "p_size"))
    lines = t.part.select(F.concat("p_partkey", F.lit(","), "p_brand", size).alias("line"))
    # One column of text with a header is a CSV file as it stands.
    path = t.scratch("csv-source")
    header = "p_partkey,p_brand,p_size"
    lines.withColumnRenamed("line", header).write.option("header", True).option("quote", "").option(
        "sep", "|"
    ).csv(path)
    bad = t.scratch("csv-bad")
    schema = "p_partkey long, p_brand string, p_size int"
    staged = sources.stage_csv(t.spark, path, t.scratch("csv-staged"), schema, bad_records=bad)
    rejects = sources.scan_text(t.spark, bad).withColumnRenamed("value", "bad_line")
    return staged.unionByName(rejects, allowMissingColumns=True)


@query("scan_csv", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def scan_csv(t):
    path = sources.write_csv(t.part, t.scratch("scan-csv"))
    return sources.scan_csv(t.spark, path, t.part.schema)


@query(
    "csv_quote_all_roundtrip",
    """SELECT doc_id, text, lang, source FROM documents""",
)
def csv_quote_all_roundtrip(t):
    """Quoted fields carry commas, quotes and line breaks of whole documents."""
    rows = t.documents.select("doc_id", "text", "lang", "source")
    path = sources.write_csv(rows, t.scratch("csv-quoted"), quote_all=True)
    return sources.scan_csv(t.spark, path, rows.schema, multiLine=True)


@query("csv_gzip_roundtrip", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def csv_gzip_roundtrip(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = sources.write_csv(rows, t.scratch("csv-gzip"), compression="gzip")
    return sources.scan_csv(t.spark, path, rows.schema)


@query("json_export_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_export_roundtrip(t):
    path = sources.write_json(t.customer, t.scratch("json-export"))
    return sources.scan_json(t.spark, path, t.customer.schema)


@query(
    "scan_text",
    """SELECT line AS value, count(*) AS entries
       FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line""",
)
def scan_text(t):
    path = sources.write_text(t.documents.select("text"), t.scratch("scan-text"))
    lines = sources.scan_text(t.spark, path)
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("entries"))


@query(
    "scan_partition_pruned",
    """SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year
       FROM orders WHERE year(o_orderdate) IN (1996, 1999)""",
)
def scan_partition_pruned(t):
    rows = t.orders.withColumn("year", F.year("o_orderdate")).select("o_orderkey", "o_custkey", "year")
    path = sources.write_parquet(rows, t.scratch("by-year"), ["year"])
    return sources.scan_parquet(t.spark, path, {"year": [1996, 1999]})


ORDERS_BY_MONTH_SQL = """SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month FROM orders"""


def _orders_by_month(t):
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
    )


@query("write_partitioned_roundtrip", ORDERS_BY_MONTH_SQL)
def write_partitioned_roundtrip(t):
    path = sources.write_parquet(
        _orders_by_month(t), t.scratch("by-month"), ["year", "month"], sort_within=["o_orderkey"], compression="gzip"
    )
    return t.spark.read.parquet(path)


@query("ingest_monthly_slices", ORDERS_BY_MONTH_SQL)
def ingest_monthly_slices(t):
    """One input folder per year; a second run finds all of them done."""
    inputs = sources.write_parquet(_orders_by_month(t), t.scratch("yearly-input"), ["year"])
    years = [r["year"] for r in t.spark.read.parquet(inputs).select("year").distinct().collect()]
    target = t.scratch("slices")
    slices = {str(y): (lambda y=y: t.spark.read.parquet(f"{inputs}/year={y}")) for y in sorted(years)}
    sources.ingest_slices(t.spark, slices, target, ["month"])
    sources.ingest_slices(t.spark, slices, target, ["month"])
    return t.spark.read.parquet(target).withColumnRenamed("slice", "year")


@query("stage_date_range", LOG_SQL + " WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'")
def stage_date_range(t):
    root = t.scratch("by-day")
    raw = _raw_events(t).withColumn("day", F.to_date(epoch_ms_to_ts("ts")))
    raw.hint("rebalance", F.col("day")).write.partitionBy("day").json(root)
    staged = sources.stage_dates(
        t.spark, root + "/day={ds}", dt.date(2024, 1, 8), dt.date(2024, 1, 21), t.scratch("by-day-staged"), LOG_SCHEMA
    )
    return staged.withColumn("ts", epoch_ms_to_ts("ts"))


@query(
    "file_manifest",
    "SELECT DISTINCT 'year=' || year(o_orderdate) AS folder, true AS has_files FROM orders",
)
def file_manifest(t):
    """The folders of the files that a partitioned write left."""
    path = sources.write_parquet(_orders_by_month(t), t.scratch("manifest"), ["year"])
    files = sources.file_manifest(t.spark, path, "*.parquet")
    folder = F.regexp_extract("path", "/(year=[0-9]+)/[^/]+$", 1).alias("folder")
    return files.groupBy(folder).agg((F.sum("length") > 0).alias("has_files"))


@query(
    "save_table_roundtrip",
    "SELECT s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier",
)
def save_table_roundtrip(t):
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    return sources.save_table(rows, "saved_supplier", ["s_nationkey"], path=t.scratch("saved-table"))


@query("table_lifecycle", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'")
def table_lifecycle(t):
    """Create when missing, insert, truncate, insert again, insert with overwrite."""
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    slim = rows.drop("c_mktsegment")
    sources.drop_table(t.spark, "lifecycle_customer")
    sources.ensure_table(t.spark, "lifecycle_customer", slim.schema, t.scratch("lifecycle"))
    slim.write.insertInto("lifecycle_customer")
    sources.truncate_table(t.spark, "lifecycle_customer")
    if t.spark.table("lifecycle_customer").limit(1).count():
        raise RuntimeError("rows are left after TRUNCATE")
    slim.write.insertInto("lifecycle_customer")
    sources.ensure_table(t.spark, "lifecycle_customer", slim.schema)
    rows.where(F.col("c_mktsegment") != "BUILDING").drop("c_mktsegment").write.insertInto(
        "lifecycle_customer", overwrite=True
    )
    return t.spark.table("lifecycle_customer")


@query(
    "catalog_load_or_build",
    """SELECT c_mktsegment, r_name, count(*) AS customers
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       GROUP BY ALL""",
)
def catalog_load_or_build(t):
    catalog = (
        Catalog(t.spark, t.scratch("catalog"))
        .add("places", lambda c: t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
        .add(
            "placed_customers",
            lambda c: t.customer.join(c.get("places"), F.col("c_nationkey") == F.col("n_nationkey")),
        )
    )
    catalog.get("placed_customers")
    return (
        catalog.get("placed_customers").groupBy("c_mktsegment", "r_name").agg(F.count(F.lit(1)).alias("customers"))
    )
