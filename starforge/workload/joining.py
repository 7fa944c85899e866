"""Join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins
from ..sources import tables
from .registry import query


@query(
    "inner_join",
    """SELECT o_orderkey, c_name, c_mktsegment, o_totalprice
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def inner_join(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "inner").select(
        "o_orderkey", "c_name", "c_mktsegment", "o_totalprice"
    )


@query(
    "bucketed_fact_dim_join",
    """SELECT o_orderkey, o_orderpriority, count(*) AS items, round(sum(l_extendedprice), 2) AS price
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def bucketed_fact_dim_join(t):
    """Items and orders in as many buckets of the order key: neither the join nor
    the totals by order move a row."""
    names = {}
    for table, key, columns in (
        (t.lineitem, "l_orderkey", ["l_orderkey", "l_extendedprice"]),
        (t.orders, "o_orderkey", ["o_orderkey", "o_orderpriority"]),
    ):
        path = t.scratch(f"bucketed-{key}")
        names[key] = f"bucketed_{key}_{path[-32:]}"
        layout = tables.Layout((key,), 16, (key,))
        tables.save_table(table.select(*columns), names[key], path=path, layout=layout)
    items, orders = t.spark.table(names["l_orderkey"]), t.spark.table(names["o_orderkey"])
    # Both sides are large tables: no broadcast is asked for, and none is needed to spare the exchange.
    joined = items.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("items"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )


def _composite(t, salts=None):
    # Only the (part, supplier) pairs that were sold in bulk are known to the lookup side.
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    known = t.lineitem.where(F.col("l_quantity") > 45).select(
        F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), "l_extendedprice", "l_returnflag"
    )
    return joins.lookup_join(
        items,
        known,
        {"l_partkey": "p", "l_suppkey": "s"},
        {"bulk_price": "l_extendedprice", "bulk_flag": "l_returnflag"},
        order_by=["l_extendedprice", "l_returnflag"],
        salts=salts,
    )


COMPOSITE_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, bulk_price, bulk_flag
    FROM lineitem LEFT JOIN (
        SELECT DISTINCT ON (l_partkey, l_suppkey) l_partkey AS p, l_suppkey AS s,
               l_extendedprice AS bulk_price, l_returnflag AS bulk_flag
        FROM lineitem WHERE l_quantity > 45
        ORDER BY l_partkey, l_suppkey, l_extendedprice, l_returnflag) ON l_partkey = p AND l_suppkey = s
"""


@query("left_lookup_composite", COMPOSITE_SQL)
def left_lookup_composite(t):
    return _composite(t)


@query("left_lookup_salted", COMPOSITE_SQL)
def left_lookup_salted(t):
    """The same lookup with the rows of frequent keys split over salts."""
    return _composite(t, salts=8)


@query(
    "left_lookup_trimmed",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, first_part
       FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN p_name || '  ' ELSE ' ' || p_name END AS name
             FROM lineitem JOIN part ON l_partkey = p_partkey)
       LEFT JOIN (SELECT trim(p_name) AS k, min(p_partkey) AS first_part FROM part
                  WHERE p_size > 25 GROUP BY k) ON trim(name) = k""",
)
def left_lookup_trimmed(t):
    named = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_linestatus") == "O", F.concat("p_name", F.lit("  ")))
        .otherwise(F.concat(F.lit(" "), "p_name")).alias("name"),
    )
    return joins.lookup_join(
        named, t.part.where(F.col("p_size") > 25), {"name": "p_name"}, {"first_part": "p_partkey"}, normalise=F.trim
    ).drop("name")


@query(
    "left_lookup_numeric",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, found_part
       FROM (SELECT l.*, p.p_name AS name, p.p_brand AS brand, p.p_retailprice AS price
             FROM lineitem l JOIN part p ON l_partkey = p_partkey)
       LEFT JOIN (SELECT p_name, p_brand, CAST(p_retailprice AS DECIMAL(18,5)) AS k, min(p_partkey) AS found_part
                  FROM part WHERE p_type <> 'PROMO' GROUP BY ALL) d
         ON name = d.p_name AND brand = d.p_brand AND CAST(price AS DECIMAL(18,5)) = k""",
)
def left_lookup_numeric(t):
    items = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"),
    )
    return joins.lookup_join(
        items,
        t.part.where(F.col("p_type") != "PROMO"),
        {"name": "p_name", "brand": "p_brand", "price": "p_retailprice"},
        {"found_part": "p_partkey"},
        normalise={"price": lambda c: c.cast("decimal(18,5)")},
    ).drop("name", "brand", "price")


@query(
    "enrich_default",
    """SELECT doc_id, lang, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def enrich_default(t):
    return joins.enrich(
        t.documents.select("doc_id", "lang"),
        t.labels,
        {"doc_id": "doc_id"},
        {"quality": "quality", "toxic": "toxic"},
        {"quality": -1, "toxic": -1},
        unique=True,
    )


@query(
    "fk_default_member",
    """SELECT c_custkey, c_name, CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN c_nationkey ELSE -1 END AS c_nationkey
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def fk_default_member(t):
    served = t.nation.join(
        t.region.where(F.col("r_name").isin("ASIA", "EUROPE")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return joins.validate_fk(
        t.customer.select("c_custkey", "c_name", "c_nationkey"), served, "c_nationkey", "n_nationkey", -1
    )


@query(
    "left_anti",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def left_anti(t):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return joins.anti(t.customer.select("c_custkey", "c_name"), urgent, {"c_custkey": "o_custkey"})


@query(
    "not_in_antijoin",
    """SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (
           SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_discount >= 0.08)""",
)
def not_in_antijoin(t):
    returned = t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.08))
    return joins.anti(t.part.select("p_partkey", "p_name"), returned, {"p_partkey": "l_partkey"})


@query(
    "left_semi_dim",
    """SELECT DISTINCT p_partkey, p_name, p_type FROM part
       WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)""",
)
def left_semi_dim(t):
    return joins.referenced_only(
        t.part.select("p_partkey", "p_name", "p_type"), t.lineitem.where(F.col("l_quantity") == 50),
        {"p_partkey": "l_partkey"},
    )


@query(
    "latest_per_key",
    """SELECT DISTINCT ON (user_id) user_id, event_type, value, ts FROM events
       ORDER BY user_id, ts DESC, event_id DESC""",
)
def latest_per_key(t):
    return joins.latest_by(t.events, ["user_id"], ["ts", "event_id"], ["event_type", "value", "ts"])


@query(
    "backfill_column",
    """SELECT o_orderkey, o_custkey, c_mktsegment AS o_orderpriority
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def backfill_column(t):
    source = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("c_mktsegment").alias("o_orderpriority")
    )
    return joins.backfill(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), source, "o_orderkey", ["o_orderpriority"])
