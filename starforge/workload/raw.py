"""Raw inputs of the two stars, derived from the driver tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .registry import Tables


def event_log(t: Tables) -> DataFrame:
    """One log event per line item: the buyer plays the part's name by its supplier."""
    # Line items are shuffled while they are narrow; what belongs to an order joins the orders.
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    ship_ms = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    sold = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        (F.col("l_returnflag") != "R").alias("is_play"),
        (F.col("l_linestatus") == "O").alias("is_paid"),
        (ship_ms + F.col("l_linenumber") * 1001).alias("ts"),
    )
    rows = (
        sold.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    is_play, is_paid = F.col("is_play"), F.col("is_paid")
    # Titles with blanks at the end match, live versions are in no catalogue.
    padded = (
        F.when(F.col("l_linenumber") % 3 == 0, F.concat("p_name", F.lit(" (live)")))
        .when(is_paid, F.concat("p_name", F.lit("  ")))
        .otherwise(F.col("p_name"))
    )
    return rows.select(
        F.when(is_play, F.col("s_name")).alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.col("c_mktsegment").alias("firstName"),
        F.when(F.col("c_acctbal") < 5000, "F").otherwise("M").alias("gender"),
        F.col("l_linenumber").cast("long").alias("itemInSession"),
        F.col("c_name").alias("lastName"),
        F.when(is_play, F.col("p_retailprice")).alias("length"),
        F.when(is_paid, "paid").otherwise("free").alias("level"),
        F.col("n_name").alias("location"),
        F.lit("PUT").alias("method"),
        F.when(is_play, "NextSong").otherwise("Home").alias("page"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("double").alias("registration"),
        F.col("l_orderkey").alias("sessionId"),
        F.when(is_play, padded).alias("song"),
        F.lit(200).cast("long").alias("status"),
        "ts",
        F.col("o_orderpriority").alias("userAgent"),
        F.col("o_custkey").cast("string").alias("userId"),
    )


EVENT_LOG_SQL = """
event_log AS (
  SELECT CASE WHEN l_returnflag <> 'R' THEN s_name END AS artist,
         c_mktsegment AS firstName,
         CASE WHEN c_acctbal < 5000 THEN 'F' ELSE 'M' END AS gender,
         CAST(l_linenumber AS BIGINT) AS itemInSession,
         c_name AS lastName,
         CASE WHEN l_returnflag <> 'R' THEN p_retailprice END AS length,
         CASE WHEN l_linestatus = 'O' THEN 'paid' ELSE 'free' END AS level,
         n_name AS location,
         CASE WHEN l_returnflag <> 'R' THEN 'NextSong' ELSE 'Home' END AS page,
         l_orderkey AS sessionId,
         CASE WHEN l_returnflag <> 'R' THEN
              CASE WHEN l_linenumber % 3 = 0 THEN p_name || ' (live)'
                   WHEN l_linestatus = 'O' THEN p_name || '  ' ELSE p_name END END AS song,
         epoch_ms(l_shipdate) + l_linenumber * 1001 AS ts,
         o_orderpriority AS userAgent,
         CAST(o_custkey AS VARCHAR) AS userId
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON c_nationkey = n_nationkey
)"""


def catalogue(t: Tables) -> DataFrame:
    """Songs: the distinct (part, supplier) pairs that were sold."""
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    rows = (
        pairs.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(
        F.concat(F.lit("A"), "l_suppkey").alias("artist_id"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("artist_latitude"),
        F.col("n_name").alias("artist_location"),
        F.lit(None).cast("double").alias("artist_longitude"),
        F.col("s_name").alias("artist_name"),
        F.col("p_retailprice").alias("duration"),
        F.lit(1).alias("num_songs"),
        F.concat(F.lit("S"), "l_partkey", F.lit("-"), "l_suppkey").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_size").alias("year"),
    )


CATALOGUE_SQL = """
catalogue AS (
  SELECT 'A' || l_suppkey AS artist_id,
         CASE WHEN s_acctbal > 0 THEN s_acctbal END AS artist_latitude,
         n_name AS artist_location,
         CAST(NULL AS DOUBLE) AS artist_longitude,
         s_name AS artist_name,
         p_retailprice AS duration,
         'S' || l_partkey || '-' || l_suppkey AS song_id,
         p_name AS title,
         p_size AS year
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
       JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey
)"""

SONGPLAYS_SQL = f"""{EVENT_LOG_SQL}, {CATALOGUE_SQL},
played AS (
  SELECT DISTINCT ON (userId, sessionId, ts, itemInSession) *
  FROM event_log WHERE page = 'NextSong'
  ORDER BY userId, sessionId, ts, itemInSession, song, artist, length, level, location, userAgent
),
songs_by_key AS (
  SELECT trim(title) AS k_title, trim(artist_name) AS k_artist,
         min(song_id) AS song_id, min_by(artist_id, song_id) AS artist_id
  FROM catalogue GROUP BY ALL
),
songplays AS (
  SELECT md5(len(CAST(sessionId AS VARCHAR)) || ':' || sessionId || len(CAST(ts * 1000 AS VARCHAR)) || ':' || ts * 1000
             || len(userId) || ':' || userId || len(CAST(itemInSession AS VARCHAR)) || ':' || itemInSession) AS songplay_id,
         userId AS user_id, song_id, artist_id, make_timestamp_ms(ts) AS start_time,
         sessionId AS session_id, level, location, userAgent AS user_agent,
         CAST(year(make_timestamp_ms(ts)) AS INTEGER) AS year,
         CAST(month(make_timestamp_ms(ts)) AS INTEGER) AS month
  FROM played LEFT JOIN songs_by_key ON trim(song) = k_title AND trim(artist) = k_artist
)"""


ARRIVAL_LIMITS = ("1995-06-01", "2001-06-30")


def arrivals(t: Tables) -> DataFrame:
    """Raw arrival records: an order is the arrival, its line items the departures."""
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    )

    def day(name: str):
        return F.unix_date(F.col(name).cast("date")) + F.lit(3653)

    return rows.select(
        F.year("o_orderdate").cast("double").alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_nationkey").cast("double")).alias("i94cit"),
        F.concat(F.lit("P"), "l_suppkey").alias("i94port"),
        day("o_orderdate").cast("double").alias("arrdate"),
        F.when(F.col("l_returnflag") != "R", day("l_shipdate").cast("double")).alias("depdate"),
        F.when(F.col("l_returnflag") != "A", F.expr("char(65 + c_nationkey)")).alias("i94addr"),
        F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyyMMdd")).alias("dtadfile"),
        F.when(F.col("l_linestatus") == "O", "M").alias("matflag"),
        F.lit(1.0).alias("count"),
    )


def port_lines(t: Tables) -> DataFrame:
    """Port label lines, one per supplier; poor suppliers give irregular lines."""
    body = (
        F.when(F.col("s_acctbal") < 500, F.concat(F.lit("Collapsed (S"), "s_suppkey", F.lit(") 06/15")))
        .when(F.col("s_acctbal") < 1000, F.concat(F.lit("No PORT Code (S"), "s_suppkey", F.lit(")")))
        .when(F.col("s_acctbal") < 1500, F.lit("Abu Dhabi"))
        .when(F.col("s_acctbal") < 2000, F.lit("LOUIS BOTHA, SOUTH AFRICA"))
        .when(F.col("s_acctbal") < 2500, F.lit("DERBY LINE, VT (RT. 5)"))
        .otherwise(F.concat(F.lit("PORT NO. "), "s_suppkey", F.lit(", "), "n_name", F.lit("   ")))
    )
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(F.concat(F.lit("   'P"), "s_suppkey", F.lit("'\t=\t'"), body, F.lit("'")).alias("value"))


AIRPORTS_SQL = """
airports AS (
  SELECT 'P' || s_suppkey AS st_ia_airport_code,
         CASE WHEN s_acctbal < 1000 THEN 'Invalid Airport Entry'
              WHEN s_acctbal < 1500 THEN 'Abu Dhabi'
              WHEN s_acctbal < 2000 THEN 'LOUIS BOTHA'
              WHEN s_acctbal < 2500 THEN 'DERBY LINE VT (RT. 5)'
              ELSE 'PORT NO. ' || s_suppkey END AS st_ia_airport_name,
         CASE WHEN s_acctbal < 1500 THEN 'Invalid State Code'
              WHEN s_acctbal < 2000 THEN 'SOUTH AFRICA'
              WHEN s_acctbal < 2500 THEN 'VT'
              ELSE n_name END AS st_ia_airport_state_code
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""


def country_lines(t: Tables) -> DataFrame:
    """Country label lines, one per customer; small balances give invalid lines."""
    name = (
        F.when(F.col("c_acctbal") < 500, F.concat(F.lit("INVALID: "), "c_name"))
        .when(F.col("c_acctbal") < 1000, F.concat(F.lit("No Country Code ("), "c_custkey", F.lit(")")))
        .when(F.col("c_acctbal") < 1500, F.concat(F.lit("Collapsed "), "c_mktsegment", F.lit(" (should not show)")))
        .otherwise(F.concat_ws(" ", "c_mktsegment", "c_name"))
    )
    return t.customer.select(F.concat(F.lit("   "), "c_custkey", F.lit(" =  '"), name, F.lit("'")).alias("value"))


def state_lines(t: Tables) -> DataFrame:
    """State label lines: a letter and the region's name per nation of a customer."""
    places = t.customer.select("c_nationkey").distinct()
    rows = places.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return rows.select(
        F.concat(F.lit("\t'"), F.expr("char(65 + c_nationkey)"), F.lit("'='"), "r_name", F.lit("'")).alias("value")
    )


def cities(t: Tables) -> DataFrame:
    """City figures as nested JSON has them, a city per customer."""
    return t.customer.select(
        F.struct(
            F.expr("char(65 + c_nationkey)").alias("state_code"),
            (F.col("c_acctbal") / 100).alias("median_age"),
            F.col("c_custkey").alias("male_population"),
            (F.col("c_custkey") + 7).alias("female_population"),
            (F.col("c_custkey") * 2 + 7).alias("total_population"),
            F.round(F.col("c_acctbal")).cast("long").alias("foreign_born"),
        ).alias("fields")
    )


STATES_SQL = """
states AS (
  SELECT chr(65 + n_nationkey) AS st_sd_state_code,
         array_to_string(list_transform(string_split(r_name, ' '),
             lambda w: upper(w[1]) || lower(w[2:])), ' ') AS st_sd_state_name,
         coalesce(age, 0.0) AS st_sd_age_median,
         coalesce(male, 0) AS st_sd_population_male,
         coalesce(female, 0) AS st_sd_population_female,
         coalesce(total, 0) AS st_sd_population_total,
         coalesce(born, 0) AS st_sd_foreign_born
  FROM nation JOIN region ON n_regionkey = r_regionkey
       LEFT JOIN (
         SELECT c_nationkey AS k, round(avg(c_acctbal / 100), 1) AS age,
                CAST(trunc(avg(c_custkey)) AS INTEGER) AS male,
                CAST(trunc(avg(c_custkey + 7)) AS INTEGER) AS female,
                CAST(trunc(avg(c_custkey * 2 + 7)) AS INTEGER) AS total,
                CAST(trunc(avg(round(c_acctbal))) AS INTEGER) AS born
         FROM customer GROUP BY c_nationkey) ON k = n_nationkey
  WHERE n_nationkey IN (SELECT c_nationkey FROM customer)
)"""

STAGED_SQL = f"""{AIRPORTS_SQL}, {STATES_SQL},
raw AS (
  SELECT DISTINCT
         CAST(coalesce(CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_nationkey END, 0) AS INTEGER) AS st_i94_cit,
         'P' || l_suppkey AS st_i94_port,
         coalesce(CASE WHEN l_returnflag <> 'A' THEN chr(65 + c_nationkey) END, '99') AS st_i94_addr,
         CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS st_i94_arrdate,
         CAST(o_orderdate AS DATE) AS st_i94_arrdate_iso,
         CAST(CASE WHEN l_returnflag <> 'R'
              THEN date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) ELSE 0 END AS INTEGER) AS st_i94_depdate,
         CASE WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) ELSE DATE '1900-01-01' END AS dep,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) ELSE DATE '9999-12-31' END AS st_i94_dtadfile,
         CASE WHEN l_linestatus = 'O' THEN 'M' ELSE 'NA' END AS st_i94_matflag,
         1 AS st_i94_count,
         CAST(year(o_orderdate) AS INTEGER) AS st_i94_year,
         CAST(month(o_orderdate) AS INTEGER) AS st_i94_month
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
),
staged AS (
  SELECT raw.* EXCLUDE (dep),
         CASE WHEN dep < DATE '{ARRIVAL_LIMITS[0]}' OR dep > DATE '{ARRIVAL_LIMITS[1]}'
                   OR st_i94_arrdate_iso > dep
              THEN DATE '1900-01-01' ELSE dep END AS st_i94_depdate_iso,
         row_number() OVER (ORDER BY st_i94_year, st_i94_month, st_i94_cit, st_i94_port, st_i94_addr,
                 st_i94_arrdate, st_i94_arrdate_iso, st_i94_depdate, dep, st_i94_dtadfile,
                 st_i94_matflag, st_i94_count) AS st_i94_id,
         coalesce(st_ia_airport_state_code, 'NA') AS st_i94_port_state_code
  FROM raw LEFT JOIN airports ON st_i94_port = st_ia_airport_code
)"""
