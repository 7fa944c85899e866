"""Projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, predicates, register_functions, text
from ..operators import projection
from ..operators.calendar import date_series_of
from ..sources import register
from ..plans.query_tables import LookupTable
from .registry import query


@query("project_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def project_columns(t):
    return t.customer.select("c_custkey", "c_name", "c_mktsegment")


@query(
    "rename_prefix",
    """SELECT s_suppkey AS d_su_suppkey, s_name AS d_su_name, s_nationkey AS d_su_nationkey,
              s_acctbal AS d_su_acctbal, s_suppkey AS d_su_id
       FROM supplier""",
)
def rename_prefix(t):
    return projection.with_key(projection.restage(t.supplier, "s_", "d_su_"), "d_su_id", "d_su_suppkey")


@query(
    "drop_columns",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders",
)
def drop_columns(t):
    return projection.except_cols(t.orders, "o_totalprice", "o_orderpriority")


@query("filter_event_type", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def filter_event_type(t):
    return t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query(
    "drop_empty_key",
    """SELECT doc_id, lang, first_line FROM (
           SELECT doc_id, lang, trim(regexp_replace(string_split(text, chr(10))[1], '[^a-z ]', '', 'g')) AS first_line
           FROM documents)
       WHERE first_line <> ''""",
)
def drop_empty_key(t):
    first = F.trim(F.regexp_replace(F.split("text", "\n")[0], "[^a-z ]", ""))
    return projection.drop_empty(t.documents.select("doc_id", "lang", first.alias("first_line")), "first_line")


@query(
    "domain_violations",
    """SELECT o_orderstatus, count(*) AS entries FROM orders
       WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus""",
)
def domain_violations(t):
    from ..operators.quality import check_domain

    return check_domain(t.orders, "o_orderstatus", ["F", "O"])


@query(
    "null_or_empty_count",
    """SELECT lang, count(*) AS entries,
              count(*) FILTER (WHERE quality IS NULL) AS blank_quality,
              count(*) FILTER (WHERE trim(regexp_replace(source, '^src[0-9]$', '')) = '') AS blank_source
       FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
)
def null_or_empty_count(t):
    rows = t.documents.join(t.labels, "doc_id", "left").select(
        "lang", "quality", F.regexp_replace("source", "^src[0-9]$", "").alias("source")
    )
    return rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(predicates.is_blank("quality")).alias("blank_quality"),
        F.count_if(predicates.is_blank("source")).alias("blank_source"),
    )


@query(
    "point_lookup",
    """SELECT c_custkey, c_name, c_acctbal FROM customer
       WHERE c_nationkey = 7 AND c_mktsegment = 'BUILDING'""",
)
def point_lookup(t):
    """From a table stored by the key: one folder is read."""
    stored = LookupTable(t.scratch("customers-by-place"), ("c_nationkey", "c_mktsegment"), ("c_custkey",))
    stored.store(t.customer)
    found = stored.get(t.spark, c_nationkey=7, c_mktsegment="BUILDING")
    return found.select("c_custkey", "c_name", "c_acctbal")


@query(
    "clean_date_bounds",
    """SELECT clean_ship, count(*) AS entries FROM (
           SELECT CASE WHEN CAST(l_shipdate AS DATE) < DATE '1996-01-01' THEN DATE '1900-01-01'
                       WHEN CAST(l_shipdate AS DATE) > DATE '2000-12-31' THEN DATE '1900-01-01'
                       WHEN o_orderdate > l_shipdate THEN DATE '1900-01-01'
                       ELSE CAST(l_shipdate AS DATE) END AS clean_ship
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       GROUP BY clean_ship""",
)
def clean_date_bounds(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    clean = predicates.clean_date("l_shipdate", "1996-01-01", "2000-12-31", "o_orderdate")
    return rows.groupBy(clean.alias("clean_ship")).agg(F.count(F.lit(1)).alias("entries"))


@query(
    "fill_defaults",
    """SELECT doc_id, source, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def fill_defaults(t):
    rows = t.documents.join(t.labels, "doc_id", "left").select("doc_id", "source", "quality", "toxic")
    return projection.fill_defaults(rows, {"quality": -1, "toxic": 0})


@query(
    "column_mismatch",
    """SELECT c_nationkey, s_nationkey, count(*) AS entries
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
       WHERE c_nationkey <> s_nationkey GROUP BY c_nationkey, s_nationkey""",
)
def column_mismatch(t):
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return (
        projection.mismatches(rows, "c_nationkey", "s_nationkey")
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.count(F.lit(1)).alias("entries"))
    )


@query(
    "dropna_rows",
    """SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
       WHERE quality IS NOT NULL AND toxic IS NOT NULL""",
)
def dropna_rows(t):
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", "lang", "quality", "toxic").dropna()


@query(
    "epoch_ms_to_ts",
    """SELECT event_id, date_trunc('milliseconds', ts) AS at_ms, date_trunc('second', ts) AS at_second
       FROM events""",
)
def epoch_ms_to_ts(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id",
        dates.epoch_ms_to_ts(ms).alias("at_ms"),
        dates.epoch_ms_to_ts(ms, "second").alias("at_second"),
    )


@query(
    "epoch_days_to_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN DATE '1900-01-01'
                               ELSE CAST(o_orderdate AS DATE) END AS order_day FROM orders""",
)
def epoch_days_to_date(t):
    days = F.datediff("o_orderdate", F.lit("1960-01-01").cast("date")).cast("double")
    raw = F.when(F.col("o_orderstatus") != "P", days)
    return t.orders.select("o_orderkey", dates.epoch_days_to_date(raw).alias("order_day"))


@query(
    "parse_yyyymmdd",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS order_day
       FROM orders""",
)
def parse_yyyymmdd(t):
    raw = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyyMMdd")).otherwise("unknown")
    return t.orders.select("o_orderkey", dates.parse_date(raw).alias("order_day"))


@query(
    "calendar_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
              CAST(week(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month,
              CAST(year(ts) AS INTEGER) AS year, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
              dayname(ts) AS day_of_week
       FROM events""",
)
def calendar_parts(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in dates.time_parts("ts").items()])


@query(
    "weekday_variants",
    """SELECT event_id, CAST(dayofweek(ts) + 1 AS INTEGER) AS sunday1, CAST(dayofweek(ts) AS INTEGER) AS sunday0,
              CAST(isodow(ts) - 1 AS INTEGER) AS monday0 FROM events""",
)
def weekday_variants(t):
    return t.events.select(
        "event_id", *[dates.day_number("ts", base).alias(base) for base in ("sunday1", "sunday0", "monday0")]
    )


@query(
    "period_labels",
    """SELECT o_orderkey, year(o_orderdate) || '/' || quarter(o_orderdate) AS year_quarter,
              strftime(o_orderdate, '%Y/%m') AS year_month FROM orders""",
)
def period_labels(t):
    return t.orders.select(
        "o_orderkey",
        dates.period_label("o_orderdate", "quarter").alias("year_quarter"),
        dates.period_label("o_orderdate", "month").alias("year_month"),
    )


@query(
    "ship_lag_days",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS lag_days
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def ship_lag_days(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.datediff("l_shipdate", "o_orderdate").alias("lag_days"),
    )


@query(
    "date_series",
    """SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date
       FROM orders""",
)
def date_series(t):
    return date_series_of(t.orders, "o_orderdate")


@query(
    "concat_name",
    "SELECT s_suppkey, s_name || ' ' || n_name AS supplier FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def concat_name(t):
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select("s_suppkey", text.full_name("s_name", "n_name").alias("supplier"))


@query(
    "initcap",
    """SELECT c_custkey, list_aggregate(list_transform(string_split(c_mktsegment || ' ' || r_name, ' '),
                lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS title
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def initcap(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return rows.select("c_custkey", F.initcap(F.concat_ws(" ", "c_mktsegment", "r_name")).alias("title"))


URL = r"^(https?)://([a-z0-9-]+)\.([a-z0-9.-]+)/([a-z]{2})/([0-9]+)"


@query(
    "regex_extract_columns",
    f"""SELECT regexp_extract(url, '{URL}', 1) AS scheme, regexp_extract(url, '{URL}', 2) AS host,
               regexp_extract(url, '{URL}', 3) AS domain, regexp_extract(url, '{URL}', 4) AS lang,
               CAST(regexp_extract(url, '{URL}', 5) AS INTEGER) AS number
        FROM pages WHERE regexp_matches(url, '{URL}')""",
)
def regex_extract_columns(t):
    return text.extract_columns(
        t.pages,
        "url",
        URL,
        {
            "scheme": (1, "string"),
            "host": (2, "string"),
            "domain": (3, "string"),
            "lang": (4, "string"),
            "number": (5, "int"),
        },
    )


@query(
    "regex_rewrite_chain",
    """SELECT p_partkey,
              regexp_replace(regexp_replace(regexp_replace(p_name, '^(small|old) ', 'used ', 'g'),
                             'widget|bolt', 'device', 'g'), ' +', '_', 'g') AS p_name,
              regexp_replace(p_brand, '#0*', '-', 'g') AS p_brand
       FROM part""",
)
def regex_rewrite_chain(t):
    return text.rewrite(
        t.part.select("p_partkey", "p_name", "p_brand"),
        [
            ("p_name", "^(small|old) ", "used "),
            ("p_name", "widget|bolt", "device"),
            ("p_name", " +", "_"),
            ("p_brand", "#0*", "-"),
        ],
    )


@query(
    "drop_matching_rows",
    """SELECT doc_id, lang, n_chars FROM documents
       WHERE NOT (regexp_matches(text, '[Ll]icense') OR regexp_matches(text, '[0-9]{3}-[0-9]{4}'))""",
)
def drop_matching_rows(t):
    return text.drop_matching(t.documents, "text", ["[Ll]icense", "[0-9]{3}-[0-9]{4}"]).select(
        "doc_id", "lang", "n_chars"
    )


@query(
    "round_cast_int",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CAST(round(l_quantity) AS INTEGER) AS quantity, round(l_discount * 100, 1) AS discount_percent
       FROM lineitem""",
)
def round_cast_int(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_discount") * 100, 1).alias("discount_percent"),
    )


@query(
    "try_cast_int",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              CASE WHEN event_type = 'error' THEN NULL
                   ELSE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS lenient_k
       FROM events""",
)
def try_cast_int(t):
    k = F.get_json_object("props", "$.k")
    return t.events.select(
        "event_id",
        text.lenient_int(k).alias("k"),
        text.lenient_int(F.when(F.col("event_type") != "error", k).otherwise("")).alias("lenient_k"),
    )


@query(
    "row_to_json",
    """SELECT s_suppkey, '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","s_nationkey":'
              || s_nationkey || '}' AS row_json
       FROM supplier""",
)
def row_to_json(t):
    return t.supplier.select("s_suppkey", text.row_json("s_suppkey", "s_name", "s_nationkey").alias("row_json"))


@query(
    "sql_function",
    """SELECT CASE WHEN o_orderstatus = 'P' THEN DATE '1900-01-01' ELSE CAST(o_orderdate AS DATE) END AS order_day,
              count(*) AS entries FROM orders GROUP BY order_day""",
)
def sql_function(t):
    register_functions(t.spark)
    register(t.orders, "sql_function_orders")
    return t.spark.sql(
        """SELECT epoch_days_to_date(CASE WHEN o_orderstatus <> 'P'
                      THEN datediff(o_orderdate, DATE'1960-01-01') END) AS order_day,
                  count(*) AS entries
           FROM sql_function_orders GROUP BY order_day"""
    )
