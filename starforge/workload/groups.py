"""Aggregations, ids, ranks, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import hash_id
from ..operators import aggregates, keys, projection, quality, ranking, sketches
from ..plans.songplay import level_popularity
from ..session import materialise
from .registry import query

LABELLED = "(SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"


def _labelled(t):
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", "lang", "quality", "toxic")


@query("group_count", "SELECT o_custkey, count(*) AS entries FROM orders GROUP BY o_custkey")
def group_count(t):
    return aggregates.group_count(t.orders, ["o_custkey"])


@query(
    "group_count_sum",
    """SELECT l_suppkey, l_returnflag, count(*) AS entries, round(sum(l_quantity), 2) AS quantity,
              round(sum(l_extendedprice), 2) AS revenue
       FROM lineitem GROUP BY ALL""",
)
def group_count_sum(t):
    return t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("entries"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
    )


@query(
    "group_avg_round",
    """SELECT c_nationkey, round(avg(c_acctbal), 1) AS avg_balance,
              CAST(trunc(avg(c_acctbal)) AS INTEGER) AS whole_balance
       FROM customer GROUP BY c_nationkey""",
)
def group_avg_round(t):
    return aggregates.group_profile(
        t.customer, ["c_nationkey"], {"avg_balance": ("c_acctbal", 1)}, {"whole_balance": "c_acctbal"}
    )


@query(
    "global_min_max",
    "SELECT min(o_orderdate) AS min_value, max(o_orderdate) AS max_value FROM orders",
)
def global_min_max(t):
    return aggregates.bounds(t.orders, "o_orderdate")


@query(
    "min_ignoring_sentinel",
    """SELECT min(d) AS min_value, max(d) AS max_value FROM (
           SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS d FROM lineitem)""",
)
def min_ignoring_sentinel(t):
    day = F.when(F.col("l_returnflag") == "R", F.lit("1900-01-01").cast("date")).otherwise(
        F.col("l_shipdate").cast("date")
    )
    return aggregates.bounds(t.lineitem.select(day.alias("d")), "d", ignore="1900-01-01")


@query("group_max", "SELECT user_id, max(ts) AS last_seen, max(value) AS top_value FROM events GROUP BY user_id")
def group_max(t):
    return t.events.groupBy("user_id").agg(F.max("ts").alias("last_seen"), F.max("value").alias("top_value"))


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query(
    "distinct_except_id",
    """SELECT min(l_orderkey) AS l_orderkey, l_partkey, l_suppkey, l_returnflag
       FROM lineitem GROUP BY l_partkey, l_suppkey, l_returnflag""",
)
def distinct_except_id(t):
    return aggregates.distinct_except(
        t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"), ["l_orderkey"]
    )


@query(
    "dup_profile",
    """SELECT CAST(sum(n) AS BIGINT) AS entries, count(*) AS distinct_entries,
              CAST(sum(n) AS BIGINT) - count(*) AS duplicates
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def dup_profile(t):
    return aggregates.dup_profile(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "id_uniqueness",
    """SELECT 'o_orderkey' AS column_name, count(o_orderkey) AS entries,
              count(DISTINCT o_orderkey) AS distinct_entries,
              count(o_orderkey) = count(DISTINCT o_orderkey) AS is_unique
       FROM orders
       UNION ALL
       SELECT 'o_custkey', count(o_custkey), count(DISTINCT o_custkey),
              count(o_custkey) = count(DISTINCT o_custkey) FROM orders""",
)
def id_uniqueness(t):
    return aggregates.unique_check(t.orders, "o_orderkey").unionByName(
        aggregates.unique_check(t.orders, "o_custkey")
    )


@query(
    "id_uniqueness_sketch",
    """SELECT 'o_orderkey' AS column_name, count(o_orderkey) AS entries,
              count(DISTINCT o_orderkey) = count(o_orderkey) AS may_be_unique, true AS within_bound FROM orders
       UNION ALL
       SELECT 'o_custkey', count(o_custkey), count(DISTINCT o_custkey) = count(o_custkey), true FROM orders
       UNION ALL
       SELECT 'o_orderstatus', count(o_orderstatus), false, true FROM orders""",
)
def id_uniqueness_sketch(t):
    """Sketches kept by month of load, merged for the total; the exact counts only
    say whether the estimates keep to their bound."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    rows = t.orders.select(*columns, F.trunc("o_orderdate", "month").alias("month"))
    kept = materialise(sketches.distinct_sketches(rows, columns, ["month"]), "sketches")
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in columns]).unpivot([], columns, "column_name", "exact")
    off = F.abs(F.col("distinct_estimate") - F.col("exact")) / F.col("exact")
    found = sketches.unique_candidates(kept).join(exact, "column_name")
    return found.select("column_name", "entries", "may_be_unique", (off <= sketches.error_bound()).alias("within_bound"))


@query(
    "missing_ratio",
    f"""SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS column_name,
               unnest([round(1 - count(doc_id) / count(*), 6), round(1 - count(lang) / count(*), 6),
                       round(1 - count(quality) / count(*), 6), round(1 - count(toxic) / count(*), 6)]) AS missing_ratio
        FROM {LABELLED}""",
)
def missing_ratio(t):
    return aggregates.missing_ratio(_labelled(t))


@query(
    "null_counts",
    f"""SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS column_name,
               unnest([count(*) - count(doc_id), count(*) - count(lang),
                       count(*) - count(quality), count(*) - count(toxic)]) AS null_entries
        FROM {LABELLED}""",
)
def null_counts(t):
    return aggregates.null_counts(_labelled(t))


@query(
    "non_null_counts",
    f"""SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS column_name,
               unnest([count(doc_id), count(lang), count(quality), count(toxic)]) AS entries
        FROM {LABELLED}""",
)
def non_null_counts(t):
    return aggregates.non_null_counts(_labelled(t))


def _describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS entries, round(avg({c}), 4) AS mean,
                   round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min_value,
                   CAST(max({c}) AS DOUBLE) AS max_value FROM {table}"""
        for c in columns
    )


@query("describe_numeric", _describe_sql("part", ["p_partkey", "p_size", "p_retailprice"]))
def describe_numeric(t):
    return aggregates.describe(t.part)


@query(
    "value_frequencies",
    "SELECT value, count(*) AS entries FROM events GROUP BY value",
)
def value_frequencies(t):
    return aggregates.value_frequencies(t.events, "value")


@query(
    "value_frequencies_top",
    "SELECT event_type, count(*) AS entries FROM events GROUP BY event_type",
)
def value_frequencies_top(t):
    return aggregates.value_frequencies(t.events, "event_type", by="entries")


@query(
    "dense_row_id",
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id, o_orderkey, o_orderdate
       FROM orders""",
)
def dense_row_id(t):
    return keys.with_row_id(
        t.orders.select("o_orderkey", "o_orderdate"), "order_id", ["o_orderdate", "o_orderkey"]
    )


@query(
    "hash_id_md5",
    """SELECT event_id, md5(len(CAST(user_id AS VARCHAR)) || ':' || user_id || len(CAST(event_id AS VARCHAR)) || ':' || event_id
                              || len(event_type) || ':' || event_type) AS hash_id FROM events""",
)
def hash_id_md5(t):
    return t.events.select("event_id", hash_id("user_id", "event_id", "event_type").alias("hash_id"))


@query(
    "append_dense_ids",
    """SELECT o_orderkey, o_orderstatus,
              row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END, o_orderkey) AS order_id
       FROM orders""",
)
def append_dense_ids(t):
    target = t.scratch("append-dense-ids")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    keys.append_with_ids(target, orders.where(F.col("o_orderstatus") != "P"), "order_id", ["o_orderkey"])
    keys.append_with_ids(target, orders.where(F.col("o_orderstatus") == "P"), "order_id", ["o_orderkey"])
    return t.spark.read.parquet(target)


@query(
    "rank_over_agg",
    """SELECT o_orderpriority AS business_model, count(*) AS ordered,
              CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS rank_number
       FROM orders GROUP BY o_orderpriority""",
)
def rank_over_agg(t):
    return level_popularity(t.orders.select(F.col("o_orderpriority").alias("level")))


@query(
    "dense_rank_over_agg",
    """SELECT lag_days, count(*) AS entries,
              CAST(dense_rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS dense_rank
       FROM (SELECT CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS lag_days
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate)
       GROUP BY lag_days""",
)
def dense_rank_over_agg(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lag = F.datediff("l_shipdate", "o_orderdate").alias("lag_days")
    # Day differences: a few thousand groups at most, whatever the row count.
    groups = aggregates.group_count(rows.select(lag).where(F.col("lag_days") >= 0), ["lag_days"])
    return ranking.rank_bounded(groups, "entries", "dense_rank", dense=True)


@query(
    "rank_many_groups",
    """SELECT o_custkey, count(*) AS entries,
              CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS order_rank
       FROM orders GROUP BY o_custkey""",
)
def rank_many_groups(t):
    """Ranks without a single-task window, as for groups that grow with the data."""
    groups = aggregates.group_count(t.orders, ["o_custkey"])
    return ranking.rank_groups(groups, "entries", "order_rank")


@query(
    "limit_n",
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20",
)
def limit_n(t):
    return ranking.first_rows(
        t.customer.select("c_custkey", "c_name", "c_acctbal"), 20, F.col("c_acctbal").desc(), "c_custkey"
    )


@query(
    "top_k_groups",
    """SELECT * FROM (SELECT l_partkey, count(*) AS entries,
                             CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS rank
                      FROM lineitem GROUP BY l_partkey) WHERE rank <= 10""",
)
def top_k_groups(t):
    return ranking.top_k_groups(aggregates.group_count(t.lineitem, ["l_partkey"]), "entries", 10)


@query(
    "clustered_lookup",
    """SELECT conv_id, turn, role, text FROM conversations
       WHERE conv_id IN (SELECT conv_id FROM conversations WHERE role = 'system')""",
)
def clustered_lookup(t):
    path = t.scratch("clustered")
    projection.clustered(t.conversations, ["conv_id"], ["turn"]).write.parquet(path)
    table = t.spark.read.parquet(path)
    guided = t.conversations.where(F.col("role") == "system").select("conv_id").distinct()
    return table.join(guided, "conv_id", "left_semi")


@query(
    "union_default_member",
    """SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
       UNION ALL SELECT -1, 'unknown', NULL, NULL, 0, NULL""",
)
def union_default_member(t):
    return projection.default_member(t.part, {"p_partkey": -1, "p_name": "unknown", "p_size": 0})


@query(
    "dq_not_blank",
    """SELECT 'labelled' AS table_name,
              count(*) FILTER (WHERE quality IS NULL) + count(*) FILTER (WHERE toxic IS NULL)
                AS null_entries,
              count(*) AS entries, 'NOK' AS status
       FROM """ + LABELLED,
)
def dq_not_blank(t):
    return quality.check_not_blank(_labelled(t), ["doc_id", "lang", "quality", "toxic"], "labelled")


def _report_sql(tables: dict[str, list[str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, 0 AS null_entries, count(*) AS entries, 'OK' AS status
            FROM {name} WHERE {" AND ".join(f"trim(CAST({c} AS VARCHAR)) <> ''" for c in cols)}"""
        for name, cols in tables.items()
    )


REPORTED = {
    "customer": ["c_custkey", "c_name", "c_nationkey"],
    "supplier": ["s_suppkey", "s_nationkey"],
    "part": ["p_partkey", "p_name"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
    "events": ["event_id", "user_id", "ts"],
}


@query("dq_report", _report_sql(REPORTED))
def dq_report(t):
    return quality.dq_report({name: (getattr(t, name), cols) for name, cols in REPORTED.items()})


@query(
    "dq_expect_sql",
    """SELECT 'orders without priority' AS check_name, CAST(count(*) AS VARCHAR) AS actual, '0' AS expected,
              CASE WHEN count(*) = 0 THEN 'OK' ELSE 'NOK' END AS status
       FROM orders WHERE o_orderpriority IS NULL
       UNION ALL
       SELECT 'unexpected order status', CAST(count(DISTINCT o_orderstatus) AS VARCHAR), '0',
              CASE WHEN count(*) = 0 THEN 'OK' ELSE 'NOK' END
       FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
       UNION ALL
       SELECT 'line items without an order', CAST(count(*) AS VARCHAR), '0',
              CASE WHEN count(*) = 0 THEN 'OK' ELSE 'NOK' END
       FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def dq_expect_sql(t):
    for name in ("orders", "lineitem"):
        getattr(t, name).createOrReplaceTempView(f"dq_{name}")
    return quality.expect_sql(
        t.spark,
        [
            ("orders without priority", "SELECT count(*) FROM dq_orders WHERE o_orderpriority IS NULL", 0),
            (
                "unexpected order status",
                "SELECT count(DISTINCT o_orderstatus) FROM dq_orders WHERE o_orderstatus NOT IN ('F', 'O')",
                0,
            ),
            (
                "line items without an order",
                "SELECT count(*) FROM dq_lineitem l LEFT ANTI JOIN dq_orders o ON l.l_orderkey = o.o_orderkey",
                0,
            ),
        ],
        strict=False,
    )


@query(
    "dq_orphans",
    """SELECT DISTINCT c_nationkey FROM customer
       WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000)""",
)
def dq_orphans(t):
    return quality.orphans(t.customer, t.supplier.where(F.col("s_acctbal") > 7000), "c_nationkey", "s_nationkey")


@query(
    "dq_date_classes",
    """SELECT date_class, count(*) AS entries FROM (
           SELECT CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' THEN 'too_early'
                       WHEN l_shipdate >= TIMESTAMP '2001-01-01' THEN 'too_late'
                       WHEN o_orderdate > l_shipdate THEN 'before_other' ELSE 'ok' END AS date_class
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY date_class""",
)
def dq_date_classes(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return quality.classify_dates(rows, "l_shipdate", lo="1996-01-01", hi="2000-12-31", not_before="o_orderdate")


STRICT_URL = r"^https://[a-z0-9.-]+/[a-z]{2}/[0-9]+$"
LENIENT_URL = r"^https?://[a-z0-9.-]+/[a-z]{2}/[0-9]+"


@query(
    "dq_regex_coverage",
    f"""SELECT count(*) AS entries,
               count(*) FILTER (WHERE regexp_matches(url, '{STRICT_URL}')) AS strict_lines,
               count(*) FILTER (WHERE regexp_matches(url, '{LENIENT_URL}')) AS lenient_lines
        FROM pages""",
)
def dq_regex_coverage(t):
    return quality.coverage(t.pages, "url", {"strict_lines": STRICT_URL, "lenient_lines": LENIENT_URL})


@query(
    "dq_regex_uncovered",
    f"""SELECT page_id, url FROM pages
        WHERE regexp_matches(url, '{LENIENT_URL}') AND NOT regexp_matches(url, '{STRICT_URL}')""",
)
def dq_regex_uncovered(t):
    return quality.uncovered(t.pages.select("page_id", "url"), "url", STRICT_URL, LENIENT_URL)
