"""Dimensions, facts and staging tables of the two stars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import time_parts
from ..operators import calendar, constraints, joins
from ..plans import dictionary, immigration, query_tables, songplay
from ..session import materialise
from ..sources import tables
from .raw import (
    AIRPORTS_SQL,
    ARRIVAL_LIMITS,
    CATALOGUE_SQL,
    EVENT_LOG_SQL,
    SONGPLAYS_SQL,
    STAGED_SQL,
    STATES_SQL,
    arrivals,
    catalogue,
    cities,
    country_lines,
    event_log,
    port_lines,
    state_lines,
)
from .registry import query


@query(
    "dim_product",
    f"WITH {CATALOGUE_SQL} SELECT DISTINCT song_id, title, artist_id, year, duration FROM catalogue",
)
def dim_product(t):
    return songplay.build_songs(catalogue(t))


@query(
    "dim_supplier",
    f"""WITH {CATALOGUE_SQL}
        SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
               artist_latitude AS latitude, artist_longitude AS longitude FROM catalogue""",
)
def dim_supplier(t):
    return songplay.build_artists(catalogue(t))


@query(
    "dim_user_latest",
    f"""WITH {EVENT_LOG_SQL}
        SELECT DISTINCT ON (userId) userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level
        FROM event_log WHERE page = 'NextSong'
        ORDER BY userId, ts DESC, sessionId DESC, itemInSession DESC, level DESC""",
)
def dim_user_latest(t):
    return songplay.build_users_latest(event_log(t))


@query(
    "dim_user_tuples",
    f"""WITH {SONGPLAYS_SQL}
        SELECT DISTINCT userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level
        FROM event_log WHERE page = 'NextSong' AND userId IN (
          SELECT user_id FROM songplays WHERE song_id IS NOT NULL)""",
)
def dim_user_tuples(t):
    """The users that plays of known songs refer to."""
    log = materialise(event_log(t), "event-log")
    plays = songplay.build_songplays(log, catalogue(t))
    return songplay.build_user_tuples(log, plays.where(F.col("song_id").isNotNull()))


@query(
    "dim_time",
    """SELECT DISTINCT ts AS start_time, CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
              CAST(week(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month,
              CAST(year(ts) AS INTEGER) AS year, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
              dayname(ts) AS day_of_week
       FROM (SELECT date_trunc('milliseconds', ts) AS ts FROM events)""",
)
def dim_time(t):
    return songplay.build_time(t.events.select(F.unix_millis(F.col("ts").cast("timestamp")).alias("ts")))


@query("fact_songplays", f"WITH {SONGPLAYS_SQL} SELECT * FROM songplays")
def fact_songplays(t):
    return songplay.build_songplays(event_log(t), catalogue(t))


@query(
    "fact_events",
    """SELECT md5(len(CAST(event_id AS VARCHAR)) || ':' || event_id || len(CAST(user_id AS VARCHAR)) || ':' || user_id) AS fact_id, event_id, user_id, c_nationkey AS nation_id,
              c_mktsegment AS segment, ts AS start_time, CAST(year(ts) AS INTEGER) AS year,
              CAST(month(ts) AS INTEGER) AS month
       FROM events LEFT JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase'""",
)
def fact_events(t):
    """The first slice: filtered events, looked up in the customer dimension."""
    from ..functions.text import hash_id

    bought = t.events.where(F.col("event_type") == "purchase")
    found = joins.lookup_join(
        bought, t.customer, {"user_id": "c_custkey"}, {"nation_id": "c_nationkey", "segment": "c_mktsegment"},
        unique=True,
    )
    parts = time_parts("ts")
    return found.select(
        hash_id("event_id", "user_id").alias("fact_id"),
        "event_id", "user_id", "nation_id", "segment", F.col("ts").alias("start_time"),
        parts["year"].alias("year"), parts["month"].alias("month"),
    )


@query(
    "stage_orders_clean",
    f"WITH {STAGED_SQL} SELECT * FROM staged",
)
def stage_orders_clean(t):
    return immigration.stage_immigrations(arrivals(t), immigration.stage_airports(port_lines(t)), ARRIVAL_LIMITS)


@query(
    "dim_label_codes",
    """SELECT CAST(c_custkey AS INTEGER) AS d_ic_country_code,
              CASE WHEN c_acctbal < 500 THEN 'INVALID: ' || c_name
                   WHEN c_acctbal < 1000 THEN 'No Country Code (' || c_custkey || ')'
                   WHEN c_acctbal < 1500 THEN 'Collapsed ' || c_mktsegment || ' (should not show)'
                   ELSE c_mktsegment || ' ' || c_name END AS d_ic_country_name,
              CAST(c_custkey AS INTEGER) AS d_ic_id
       FROM customer WHERE c_acctbal >= 1500 OR c_custkey = 999""",
)
def dim_label_codes(t):
    return immigration.build_countries(immigration.stage_countries(country_lines(t)))


@query(
    "dim_label_rewrites",
    f"""WITH {AIRPORTS_SQL}
        SELECT st_ia_airport_code AS d_ia_airport_code, st_ia_airport_name AS d_ia_airport_name,
               st_ia_airport_state_code AS d_ia_airport_state_code, st_ia_airport_code AS d_ia_id FROM airports""",
)
def dim_label_rewrites(t):
    return immigration.build_airports(immigration.stage_airports(port_lines(t)))


@query(
    "dim_nation_profile",
    f"""WITH {STATES_SQL}
        SELECT st_sd_state_code AS d_sd_state_code, st_sd_state_name AS d_sd_state_name,
               st_sd_age_median AS d_sd_age_median, st_sd_population_male AS d_sd_population_male,
               st_sd_population_female AS d_sd_population_female, st_sd_population_total AS d_sd_population_total,
               st_sd_foreign_born AS d_sd_foreign_born, st_sd_state_code AS d_sd_id FROM states""",
)
def dim_nation_profile(t):
    return immigration.build_states(immigration.stage_states(state_lines(t), cities(t)))


def _date_columns(p: str) -> str:
    return f"""d AS {p}date, d AS {p}id, CAST(year(d) AS INTEGER) AS {p}year,
       year(d) || '/' || quarter(d) AS {p}year_quarter, strftime(d, '%Y/%m') AS {p}year_month,
       CAST(quarter(d) AS INTEGER) AS {p}quarter, CAST(month(d) AS INTEGER) AS {p}month,
       CAST(week(d) AS INTEGER) AS {p}week, dayname(d) AS {p}weekday, dayname(d)[:3] AS {p}weekday_short,
       CAST(dayofweek(d) + 1 AS INTEGER) AS {p}dayofweek, CAST(day(d) AS INTEGER) AS {p}day"""


@query(
    "dim_date",
    f"""SELECT {_date_columns("d_da_")} FROM (
          SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d
          FROM orders)""",
)
def dim_date(t):
    return calendar.build_date_dimension(t.orders, "o_orderdate", "d_da_")


@query(
    "dim_date_with_default",
    f"""SELECT {_date_columns("d_dd_")} FROM (
          SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d
          FROM lineitem WHERE l_returnflag <> 'R'
          UNION ALL SELECT DATE '1900-01-01')""",
)
def dim_date_with_default(t):
    day = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate").cast("date")).otherwise(
        F.lit("1900-01-01").cast("date")
    )
    return calendar.build_date_dimension(t.lineitem.select(day.alias("d")), "d", "d_dd_", default="1900-01-01")


FACT_SQL = f"""{STAGED_SQL},
fact AS (
  SELECT st_i94_id AS f_i94_id, st_i94_cit AS f_i94_cit, st_i94_port AS f_i94_port, st_i94_addr AS f_i94_addr,
         st_i94_arrdate_iso AS f_i94_arrdate_iso, st_i94_depdate_iso AS f_i94_depdate_iso,
         st_i94_dtadfile AS f_i94_dtadfile, st_i94_matflag AS f_i94_matflag, st_i94_count AS f_i94_count,
         st_i94_year AS f_i94_year, st_i94_month AS f_i94_month,
         st_i94_port_state_code AS f_i94_port_state_code, st_i94_port AS d_ia_id,
         CASE WHEN st_i94_addr IN (SELECT st_sd_state_code FROM states) THEN st_i94_addr ELSE '99' END AS d_sd_id,
         st_i94_arrdate_iso AS d_da_id, st_i94_depdate_iso AS d_dd_id, st_i94_cit AS d_ic_id
  FROM staged
)"""


@query("fact_with_validated_fk", f"WITH {FACT_SQL} SELECT * FROM fact")
def fact_with_validated_fk(t):
    staged = immigration.stage_immigrations(
        arrivals(t), immigration.stage_airports(port_lines(t)), ARRIVAL_LIMITS
    )
    return immigration.build_immigrations(
        staged, immigration.build_states(immigration.stage_states(state_lines(t), cities(t)))
    )


def _stored(t, name, build):
    """The table written by its key and read back."""
    rows = build(event_log(t).where(F.col("artist").isNotNull()))
    return query_tables.lookup_table(name, t.scratch(name)).store(rows)


@query(
    "q_item_by_key",
    f"""WITH {EVENT_LOG_SQL}
        SELECT DISTINCT ON (sessionId, itemInSession) sessionId, itemInSession, artist, song, length
        FROM event_log WHERE artist IS NOT NULL
        ORDER BY sessionId, itemInSession, ts DESC, artist DESC, song DESC""",
)
def q_item_by_key(t):
    return _stored(t, "item_by_session", query_tables.item_by_session)


@query(
    "q_items_ordered",
    f"""WITH {EVENT_LOG_SQL}
        SELECT DISTINCT ON (userId, sessionId, itemInSession) userId, sessionId, itemInSession, artist, song,
               firstName || ' ' || lastName AS user
        FROM event_log WHERE artist IS NOT NULL
        ORDER BY userId, sessionId, itemInSession, ts DESC, artist DESC, song DESC""",
)
def q_items_ordered(t):
    return _stored(t, "items_of_user_session", query_tables.items_of_user_session)


@query(
    "q_users_by_item",
    f"""WITH {EVENT_LOG_SQL}
        SELECT DISTINCT song, userId, firstName || ' ' || lastName AS user
        FROM event_log WHERE artist IS NOT NULL""",
)
def q_users_by_item(t):
    return _stored(t, "users_by_song", query_tables.users_by_song)


DESCRIBED = {
    "customer": "buyers",
    "orders": "one row per order",
}
DESCRIBED_COLUMNS = {("customer", "c_custkey"): "primary key", ("orders", "o_custkey"): "buyer of the order"}
KEYS = {"customer": ["c_custkey"], "orders": ["o_orderkey"]}
SPARK_TYPES = {
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                 "c_mktsegment": "string"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
}


def _dictionary_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{DESCRIBED.get(table, "not set")}' AS table_description,
                   {i} AS position, '{c}' AS column_name,
                   '{DESCRIBED_COLUMNS.get((table, c), "not set")}' AS column_description,
                   '{kind}' AS column_type, {c not in KEYS.get(table, ())} AS column_nullable, count(*) AS table_entries, count({c}) AS column_entries
            FROM {table}"""
        for table, columns in SPARK_TYPES.items()
        for i, (c, kind) in enumerate(columns.items(), start=1)
    )


@query("data_dictionary", _dictionary_sql())
def data_dictionary(t):
    """Read from catalogue tables that carry their comments and keys, written as
    quoted CSV and read back."""
    names = {}
    for table in SPARK_TYPES:
        path = t.scratch(f"described-{table}")
        names[table] = f"described_{table}_{path[-32:]}"
        texts = {c: text for (owner, c), text in DESCRIBED_COLUMNS.items() if owner == table}
        rows = tables.described(getattr(t, table), texts)
        tables.ensure_table(
            t.spark, names[table], rows.schema, path, primary_key=KEYS.get(table, ()), comment=DESCRIBED.get(table)
        )
        constraints.load_table(rows, names[table], "truncate_load")
    rows = dictionary.catalogue_dictionary(t.spark, names, with_entries=True)
    return dictionary.export_dictionary(rows, t.scratch("dictionary"))
