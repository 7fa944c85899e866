"""Ranked star-join reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar, joins, ranking
from ..plans import immigration, songplay
from ..session import materialise
from ..sources.writers import write_parquet
from .raw import (
    ARRIVAL_LIMITS,
    SONGPLAYS_SQL,
    arrivals,
    catalogue,
    cities,
    country_lines,
    event_log,
    port_lines,
    state_lines,
)
from .registry import query
from .stars import FACT_SQL


@query(
    "star_rank_country",
    """SELECT n_nationkey AS country_id, n_name AS country, count(*) AS entries,
              CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS entries_rank
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name""",
)
def star_rank_country(t):
    counts = joins.star_query(
        t.customer,
        [(t.nation, "c_nationkey", "n_nationkey", "inner")],
        {"country_id": "c_nationkey", "country": "n_name"},
        {"entries": ("count", "c_custkey")},
    )
    # Groups are nations: a fixed, short list.
    return ranking.rank_bounded(counts, "entries", "entries_rank")


@query(
    "star_rank_supplier",
    """SELECT s_suppkey AS supplier_id, s_name AS supplier, round(sum(l_quantity), 2) AS quantity,
              count(*) AS entries, CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS entries_rank
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_name""",
)
def star_rank_supplier(t):
    counts = joins.star_query(
        t.lineitem,
        [(t.supplier, "l_suppkey", "s_suppkey", "inner")],
        {"supplier_id": "l_suppkey", "supplier": "s_name"},
        {"quantity": ("sum", "l_quantity"), "entries": ("count", "l_orderkey")},
    ).withColumn("quantity", F.round("quantity", 2))
    return ranking.rank_groups(counts, "entries", "entries_rank")


@query(
    "star_rank_month",
    """SELECT strftime(o_orderdate, '%Y/%m') AS year_month, count(*) AS entries,
              CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS entries_rank
       FROM orders GROUP BY year_month""",
)
def star_rank_month(t):
    days = calendar.build_date_dimension(t.orders, "o_orderdate", "d_da_").select("d_da_id", "d_da_year_month")
    fact = t.orders.withColumn("d_da_id", F.col("o_orderdate").cast("date"))
    counts = joins.star_query(
        fact,
        [(days, "d_da_id", "d_da_id", "inner")],
        {"year_month": "d_da_year_month"},
        {"entries": ("count", "o_orderkey")},
    )
    # Groups are calendar months.
    return ranking.rank_bounded(counts, "entries", "entries_rank")


@query(
    "star_month_pruned",
    """SELECT strftime(l_shipdate, '%Y/%m') AS year_month, s_name AS supplier, count(*) AS entries,
              round(sum(l_quantity), 2) AS quantity
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       WHERE quarter(l_shipdate) = 2 AND strftime(l_shipdate, '%Y/%m') BETWEEN
             (SELECT strftime(min(o_orderdate), '%Y/%m') FROM orders) AND (SELECT strftime(max(o_orderdate), '%Y/%m') FROM orders)
       GROUP BY ALL""",
)
def star_month_pruned(t):
    """Second-quarter shipments by month and supplier, from a fact in monthly
    folders of which only the calendar's months are read."""
    fact = t.lineitem.select(
        "l_suppkey", "l_quantity", F.date_format("l_shipdate", "yyyy/MM").alias("year_month"),
        F.year("l_shipdate").alias("ship_year"), F.month("l_shipdate").alias("ship_month"),
    )
    path = write_parquet(fact, t.scratch("shipped-by-month"), ["ship_year", "ship_month"])
    days = materialise(calendar.build_date_dimension(t.orders, "o_orderdate", "d_da_"), "calendar")
    quarter = days.where(F.quarter("d_da_id") == 2)
    months = {"ship_year": "d_da_year", "ship_month": "d_da_month"}
    return joins.star_query(
        joins.within(t.spark.read.parquet(path), quarter, months),
        [(t.supplier, "l_suppkey", "s_suppkey", "inner")],
        {"year_month": "year_month", "supplier": "s_name"},
        {"entries": ("count", "l_suppkey"), "quantity": ("sum", "l_quantity")},
    ).withColumn("quantity", F.round("quantity", 2))


@query(
    "star_rank_profile",
    """WITH profile AS (
         SELECT s_nationkey, round(avg(s_acctbal), 1) AS balance, count(*) AS suppliers
         FROM supplier GROUP BY s_nationkey)
       SELECT n_name AS nation, balance, suppliers, count(*) AS customers,
              CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS customers_rank
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN profile ON s_nationkey = n_nationkey
       GROUP BY n_name, balance, suppliers""",
)
def star_rank_profile(t):
    figures = t.supplier.groupBy("s_nationkey").agg(
        F.round(F.avg("s_acctbal"), 1).alias("balance"), F.count(F.lit(1)).alias("suppliers")
    )
    profile = t.nation.join(figures, F.col("n_nationkey") == F.col("s_nationkey"))
    counts = joins.star_query(
        t.customer,
        [(profile, "c_nationkey", "n_nationkey", "inner")],
        {"nation": "n_name", "balance": "balance", "suppliers": "suppliers"},
        {"customers": ("count", "c_custkey")},
    )
    # Groups are nations: a fixed, short list.
    return ranking.rank_bounded(counts, "customers", "customers_rank")


@query(
    "star_two_dates",
    """SELECT strftime(o_orderdate, '%Y/%m') AS ordered_in,
              CASE WHEN l_shipdate >= o_orderdate THEN strftime(l_shipdate, '%Y/%m') END AS shipped_in,
              count(*) AS entries
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def star_two_dates(t):
    """Inner join to the order calendar, left join to the shipping calendar."""
    days = calendar.build_date_dimension(t.orders, "o_orderdate", "d_da_").select("d_da_id", "d_da_year_month")
    ship = calendar.build_date_dimension(t.lineitem, "l_shipdate", "d_dd_").select("d_dd_id", "d_dd_year_month")
    fact = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderdate").cast("date").alias("d_da_id"),
        F.when(F.col("l_shipdate") >= F.col("o_orderdate"), F.col("l_shipdate").cast("date")).alias("d_dd_id"),
        "l_orderkey",
    )
    return joins.star_query(
        fact,
        [(days, "d_da_id", "d_da_id", "inner"), (ship, "d_dd_id", "d_dd_id", "left")],
        {"ordered_in": "d_da_year_month", "shipped_in": "d_dd_year_month"},
        {"entries": ("count", "l_orderkey")},
    )


@query(
    "most_bought_parts",
    """SELECT s_name AS supplier, p_name AS part, p_size AS size, count(*) AS bought
       FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       GROUP BY ALL""",
)
def most_bought_parts(t):
    return joins.star_query(
        t.lineitem,
        [(t.part, "l_partkey", "p_partkey", "inner"), (t.supplier, "l_suppkey", "s_suppkey", "inner")],
        {"supplier": "s_name", "part": "p_name", "size": "p_size"},
        {"bought": ("count", "l_orderkey")},
    )


@query(
    "most_played_songs",
    f"""WITH {SONGPLAYS_SQL}
        SELECT a.name AS artist_name, s.title AS song_title, s.year AS song_year,
               count(p.user_id) AS song_played_how_often
        FROM songplays p JOIN (SELECT DISTINCT artist_id, artist_name AS name FROM catalogue) a
               ON p.artist_id = a.artist_id
             JOIN (SELECT DISTINCT song_id, title, year FROM catalogue) s ON p.song_id = s.song_id
        GROUP BY ALL""",
)
def most_played_songs(t):
    songs = materialise(catalogue(t), "catalogue")
    fact = songplay.build_songplays(event_log(t), songs)
    return songplay.most_played(fact, songplay.build_songs(songs), songplay.build_artists(songs))


@query(
    "users_by_location",
    f"""WITH {SONGPLAYS_SQL}
        SELECT location AS user_location, count(*) AS users_amount FROM songplays GROUP BY location""",
)
def users_by_location(t):
    return songplay.users_by_location(songplay.build_songplays(event_log(t), catalogue(t)))


QUESTION_SQL = {
    "question_origin_countries": f"""WITH {FACT_SQL}
        SELECT f_i94_cit AS country_id, c_mktsegment || ' ' || c_name AS country, count(*) AS immigrants,
               CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS immigrants_rank
        FROM fact JOIN customer ON d_ic_id = c_custkey WHERE c_acctbal >= 1500
        GROUP BY f_i94_cit, c_mktsegment, c_name""",
    "question_arrival_airports": f"""WITH {FACT_SQL}
        SELECT st_ia_airport_code AS airport_code, st_ia_airport_name AS airport_name,
               st_ia_airport_state_code AS airport_state_code, CAST(sum(f_i94_count) AS BIGINT) AS immigrants,
               CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS airport_rank
        FROM fact JOIN airports ON d_ia_id = st_ia_airport_code GROUP BY ALL""",
    "question_arrival_months": f"""WITH {FACT_SQL}
        SELECT strftime(d_da_id, '%Y/%m') AS year_month, count(*) AS immigrants,
               CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS immigrants_rank
        FROM fact GROUP BY year_month""",
    "question_destination_states": f"""WITH {FACT_SQL}
        SELECT CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS travel_rank,
               st_sd_state_code AS state_code, st_sd_state_name AS state_name, count(*) AS immigrants,
               st_sd_age_median AS age_median, st_sd_population_male AS population_male,
               st_sd_population_female AS population_female, st_sd_population_total AS population_total,
               st_sd_foreign_born AS foreign_born
        FROM fact JOIN states ON d_sd_id = st_sd_state_code GROUP BY ALL""",
    "question_departure_months": f"""WITH {FACT_SQL}
        SELECT strftime(d_da_id, '%Y/%m') AS year_month_arrival, strftime(d_dd_id, '%Y/%m') AS year_month_departure,
               count(*) AS immigrants
        FROM fact GROUP BY ALL""",
    "question_stay_lengths": f"""WITH {FACT_SQL}
        SELECT CAST(date_diff('day', d_da_id, d_dd_id) AS INTEGER) AS days_after_arrival, count(*) AS immigrants,
               CAST(dense_rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS immigrants_rank
        FROM fact WHERE d_dd_id <> DATE '1900-01-01' GROUP BY days_after_arrival""",
}


def _catalog(t):
    """A new immigration star: what a question needs of it is built for it."""
    return immigration.immigration_catalog(
        t.spark,
        t.scratch("immigration"),
        raw=lambda: arrivals(t),
        country_lines=lambda: country_lines(t),
        port_lines=lambda: port_lines(t),
        state_lines=lambda: state_lines(t),
        cities=lambda: cities(t),
        limits=ARRIVAL_LIMITS,
    )


def _register(name: str) -> None:
    @query(f"question_{name}", QUESTION_SQL[f"question_{name}"])
    def answer(t):
        return _catalog(t).answer(immigration.QUESTIONS[name], export_to=t.scratch("answer"))


for _name in immigration.QUESTIONS:
    _register(_name)


def _answers_sql() -> str:
    """All answers as (question, rank, row), the row as JSON of the columns in order."""
    parts = []
    for name, question in immigration.QUESTIONS.items():
        shown = [*question.group_by, *[m for m in question.measures if m not in question.hidden]]
        fields = ", ".join(f"{c} := {c}" for c in shown)
        rank = question.rank or "NULL"
        parts.append(
            f"SELECT '{name}' AS question, CAST({rank} AS INTEGER) AS rank, "
            f"CAST(to_json(struct_pack({fields})) AS VARCHAR) AS row FROM ({QUESTION_SQL['question_' + name]})"
        )
    return " UNION ALL ".join(parts)


@query("immigration_answers", _answers_sql())
def immigration_answers(t):
    """One star, every answer."""
    return _catalog(t).answers(immigration.QUESTIONS)
