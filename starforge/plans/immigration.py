"""The immigration star: label files, calendars, state profiles and arrivals."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import epoch_days_to_date, parse_date
from ..functions.predicates import clean_date
from ..functions.text import Repair, extract_columns, repair
from ..operators.aggregates import group_profile
from ..operators.calendar import build_date_dimension
from ..operators.joins import enrich, validate_fk
from ..operators.keys import with_row_id
from ..operators.projection import restage, with_key
from .catalog import Catalog, Question

# A label line is a code, an equals sign and a quoted text; blanks vary by file.
# A port's text ends in its state, a word after the last blank but for filling.
COUNTRY_LINE = r"^\s*(\d+)\s*=\s*'(.*)'"
PORT_LINE = r"^\s*'([^']*)'\s*=\s*'(.+) ([\w/]+)"
STATE_LINE = r"^\s*'(\w+)'\s*=\s*'([^']+)'"

# Texts by which country names that are no countries begin, a text
# that such names have anywhere, and the default member.
NO_COUNTRY_STARTS = ("No Country Code ", "INVALID:")
NO_COUNTRY_MARK = "(should not show)"
DEFAULT_COUNTRY = 999

# Texts for port labels without a usable name or state.
NO_PORT = "Invalid Airport Entry"
NO_STATE = "Invalid State Code"

# The port labels that need repair, by the extracted name.
PORT_REPAIRS = (
    Repair("port_name", r"^Collapsed \(\w+\)", {"port_name": NO_PORT, "state_code": NO_STATE}),
    Repair("port_name", r"^No PORT", {"port_name": NO_PORT, "state_code": NO_STATE}),
    Repair("port_name", r"^UNKNOWN", {"port_name": NO_PORT, "state_code": NO_STATE}),
    Repair("port_name", r"^DERBY LINE", {"port_name": "DERBY LINE VT (RT. 5)", "state_code": "VT"}),
    Repair("port_name", r"^LOUIS BOTHA", {"port_name": "LOUIS BOTHA", "state_code": "SOUTH AFRICA"}),
    Repair("port_name", r"^PASO DEL", {"port_name": "PASO DEL NORTE", "state_code": "TX"}),
    Repair("port_name", r"^UNIDENTIFED AIR", {"port_name": NO_PORT, "state_code": NO_STATE}),
    Repair("port_name", r"^Abu", {"port_name": "Abu Dhabi", "state_code": NO_STATE}),
    Repair("port_name", r"^DOVER-AFB", {"port_name": NO_PORT, "state_code": NO_STATE}),
    Repair("port_name", r"^NOT$", {"port_name": NO_PORT, "state_code": NO_STATE}),
    Repair("port_name", r"^INVALID - IWAKUNI", {"port_name": "IWAKUNI", "state_code": "JAPAN"}),
)

# Fills, date limits and default members of the arrival records.
DEFAULT_STATE = "99"
FILLS = {"i94cit": 0.0, "i94addr": DEFAULT_STATE, "depdate": 0.0, "dtadfile": "99991231", "matflag": "NA"}
NO_DATE = "1900-01-01"
DEPARTURE_LIMITS = ("2016-01-01", "2017-06-14")
PROFILE_COLUMNS = ("age_median", "population_male", "population_female", "population_total", "foreign_born")


def stage_countries(lines: DataFrame) -> DataFrame:
    """Country labels without the invalid ones; the default member is kept."""
    labels = extract_columns(
        lines, "value", COUNTRY_LINE, {"st_ic_country_code": (1, "int"), "st_ic_country_name": (2, "string")}
    ).distinct()
    name = F.col("st_ic_country_name")
    invalid = name.contains(NO_COUNTRY_MARK)
    for text in NO_COUNTRY_STARTS:
        invalid = invalid | name.startswith(text)
    return labels.where(~invalid | (F.col("st_ic_country_code") == DEFAULT_COUNTRY))


def stage_airports(lines: DataFrame) -> DataFrame:
    """Port labels, with the irregular ones repaired row by row."""
    labels = extract_columns(
        lines,
        "value",
        PORT_LINE,
        {"port_code": (1, "string"), "port_name": (2, "string"), "state_code": (3, "string")},
    )
    plain = labels.where(F.col("port_code") != "").withColumn(
        "port_name", F.rtrim(F.regexp_replace("port_name", ",", ""))
    )
    return (
        repair(plain, PORT_REPAIRS)
        .distinct()
        .select(
            F.col("port_code").alias("st_ia_airport_code"),
            F.col("port_name").alias("st_ia_airport_name"),
            F.col("state_code").alias("st_ia_airport_state_code"),
        )
    )


def stage_states(lines: DataFrame, cities: DataFrame) -> DataFrame:
    """State labels with averaged city figures; states without cities get zeros."""
    labels = extract_columns(
        lines, "value", STATE_LINE, {"st_sd_state_code": (1, "string"), "st_sd_state_name": (2, "string")}
    ).distinct()
    figures = group_profile(
        cities.select("fields.*"),
        ["state_code"],
        {"st_sd_age_median": ("median_age", 1)},
        {
            "st_sd_population_male": "male_population",
            "st_sd_population_female": "female_population",
            "st_sd_population_total": "total_population",
            "st_sd_foreign_born": "foreign_born",
        },
    )
    names = [f"st_sd_{c}" for c in PROFILE_COLUMNS]
    zeros = {n: 0.0 if n == "st_sd_age_median" else 0 for n in names}
    named = labels.withColumn("st_sd_state_name", F.initcap("st_sd_state_name"))
    return enrich(named, figures, {"st_sd_state_code": "state_code"}, {n: n for n in names}, zeros)


def stage_immigrations(raw: DataFrame, airports: DataFrame, limits: tuple[str, str] = DEPARTURE_LIMITS) -> DataFrame:
    """Filled, typed, distinct and numbered arrival records with cleaned departure dates."""
    filled = raw.fillna(FILLS)
    typed = filled.select(
        F.round("i94cit").cast("int").alias("st_i94_cit"),
        F.col("i94port").alias("st_i94_port"),
        F.col("i94addr").alias("st_i94_addr"),
        F.round("arrdate").cast("int").alias("st_i94_arrdate"),
        epoch_days_to_date("arrdate", default=NO_DATE).alias("st_i94_arrdate_iso"),
        F.round("depdate").cast("int").alias("st_i94_depdate"),
        epoch_days_to_date("depdate", default=NO_DATE).alias("st_i94_depdate_iso"),
        parse_date("dtadfile").alias("st_i94_dtadfile"),
        F.col("matflag").alias("st_i94_matflag"),
        F.round("count").cast("int").alias("st_i94_count"),
        F.col("i94yr").cast("int").alias("st_i94_year"),
        F.col("i94mon").cast("int").alias("st_i94_month"),
    ).distinct()
    lead = ["st_i94_year", "st_i94_month", "st_i94_cit"]
    numbered = with_row_id(typed, "st_i94_id", lead + [c for c in typed.columns if c not in lead])
    placed = enrich(
        numbered,
        airports,
        {"st_i94_port": "st_ia_airport_code"},
        {"st_i94_port_state_code": "st_ia_airport_state_code"},
        {"st_i94_port_state_code": "NA"},
    )
    return placed.withColumn(
        "st_i94_depdate_iso",
        clean_date("st_i94_depdate_iso", *limits, not_before="st_i94_arrdate_iso", default=NO_DATE),
    )


def build_countries(staged: DataFrame) -> DataFrame:
    return with_key(restage(staged, "st_", "d_"), "d_ic_id", "d_ic_country_code")


def build_airports(staged: DataFrame) -> DataFrame:
    return with_key(restage(staged, "st_", "d_"), "d_ia_id", "d_ia_airport_code")


def build_states(staged: DataFrame) -> DataFrame:
    return with_key(restage(staged, "st_", "d_"), "d_sd_id", "d_sd_state_code")


def build_arrival_dates(staged: DataFrame) -> DataFrame:
    return build_date_dimension(staged, "st_i94_arrdate_iso", "d_da_")


def build_departure_dates(staged: DataFrame) -> DataFrame:
    return build_date_dimension(staged, "st_i94_depdate_iso", "d_dd_", default=NO_DATE)


def build_immigrations(staged: DataFrame, states: DataFrame) -> DataFrame:
    """The fact: staged rows with foreign keys; unknown states become the default member."""
    fact = restage(staged.drop("st_i94_arrdate", "st_i94_depdate"), "st_", "f_")
    keyed = fact.withColumns(
        {
            "d_ia_id": F.col("f_i94_port"),
            "d_sd_id": F.col("f_i94_addr"),
            "d_da_id": F.col("f_i94_arrdate_iso"),
            "d_dd_id": F.col("f_i94_depdate_iso"),
            "d_ic_id": F.col("f_i94_cit"),
        }
    )
    return validate_fk(keyed, states, "d_sd_id", "d_sd_id", DEFAULT_STATE)


ENTRIES = ("count", "f_i94_count")
QUESTIONS: Mapping[str, Question] = {
    "origin_countries": Question(
        "From which countries do immigrants come, and how many?",
        "f_i94_immigrations",
        dims=(("d_immigration_countries", "d_ic_id", "inner"),),
        group_by={"country_id": "f_i94_cit", "country": "d_ic_country_name"},
        measures={"immigrants": ENTRIES},
        rank="immigrants_rank",
    ),
    "arrival_airports": Question(
        "At which airports do they arrive?",
        "f_i94_immigrations",
        dims=(("d_immigration_airports", "d_ia_id", "inner"),),
        group_by={
            "airport_code": "d_ia_airport_code",
            "airport_name": "d_ia_airport_name",
            "airport_state_code": "d_ia_airport_state_code",
        },
        measures={"immigrants": ("sum", "f_i94_count"), "entries": ENTRIES},
        rank="airport_rank",
        rank_by="entries",
        hidden=("entries",),
    ),
    "arrival_months": Question(
        "At which times do they arrive?",
        "f_i94_immigrations",
        dims=(("d_date_arrivals", "d_da_id", "inner"),),
        group_by={"year_month": "d_da_year_month"},
        measures={"immigrants": ENTRIES},
        rank="immigrants_rank",
    ),
    "destination_states": Question(
        "To which states do they travel on, and what are those like?",
        "f_i94_immigrations",
        dims=(("d_state_destinations", "d_sd_id", "inner"),),
        group_by={
            "state_code": "d_sd_state_code",
            "state_name": "d_sd_state_name",
            **{name: f"d_sd_{name}" for name in PROFILE_COLUMNS},
        },
        measures={"immigrants": ENTRIES},
        rank="travel_rank",
    ),
    "departure_months": Question(
        "When do they arrive, and when do they leave?",
        "f_i94_immigrations",
        dims=(("d_date_arrivals", "d_da_id", "inner"), ("d_date_departures", "d_dd_id", "left")),
        group_by={"year_month_arrival": "d_da_year_month", "year_month_departure": "d_dd_year_month"},
        measures={"immigrants": ENTRIES},
        order_by=("year_month_arrival", "year_month_departure"),
    ),
    "stay_lengths": Question(
        "After how many days do they leave?",
        "f_i94_immigrations",
        dims=(("d_date_arrivals", "d_da_id", "inner"), ("d_date_departures", "d_dd_id", "inner")),
        derived={"days": lambda: F.datediff("f_i94_depdate_iso", "f_i94_arrdate_iso")},
        only=lambda: F.col("f_i94_depdate_iso") != F.lit(NO_DATE).cast("date"),
        group_by={"days_after_arrival": "days"},
        measures={"immigrants": ENTRIES},
        rank="immigrants_rank",
        dense=True,
    ),
}

KEY_COLUMNS: Mapping[str, list[str]] = {
    "f_i94_immigrations": ["f_i94_id", "d_ia_id", "d_sd_id", "d_da_id", "d_dd_id", "d_ic_id"],
    "d_immigration_countries": ["d_ic_id"],
    "d_immigration_airports": ["d_ia_id"],
    "d_date_arrivals": ["d_da_id"],
    "d_date_departures": ["d_dd_id"],
    "d_state_destinations": ["d_sd_id"],
}


def immigration_catalog(
    spark: SparkSession,
    root: str,
    raw: Callable[[], DataFrame],
    country_lines: Callable[[], DataFrame],
    port_lines: Callable[[], DataFrame],
    state_lines: Callable[[], DataFrame],
    cities: Callable[[], DataFrame],
    limits: tuple[str, str] = DEPARTURE_LIMITS,
) -> Catalog:
    """All staging tables, dimensions and the fact, built on first use.

    Only the fact is partitioned, by year and month: a folder per dimension
    member would be a folder per row.
    """
    months = ("f_i94_year", "f_i94_month")
    return (
        Catalog(spark, root)
        .add("st_immigration_countries", lambda c: stage_countries(country_lines()))
        .add("st_immigration_airports", lambda c: stage_airports(port_lines()))
        .add("st_state_destinations", lambda c: stage_states(state_lines(), cities()))
        .add(
            "st_i94_immigrations",
            lambda c: stage_immigrations(raw(), c.get("st_immigration_airports"), limits),
        )
        .add("d_immigration_countries", lambda c: build_countries(c.get("st_immigration_countries")))
        .add("d_immigration_airports", lambda c: build_airports(c.get("st_immigration_airports")))
        .add("d_state_destinations", lambda c: build_states(c.get("st_state_destinations")))
        .add("d_date_arrivals", lambda c: build_arrival_dates(c.get("st_i94_immigrations")))
        .add("d_date_departures", lambda c: build_departure_dates(c.get("st_i94_immigrations")))
        .add(
            "f_i94_immigrations",
            _fact,
            months,
            # A file of the staging table, numbered by year and month, holds few months.
            dealt=True,
        )
    )


def _fact(c: Catalog) -> DataFrame:
    tables = c.build("st_i94_immigrations", "d_state_destinations")
    return build_immigrations(tables["st_i94_immigrations"], tables["d_state_destinations"])
