"""The songplay star: users, songs, artists, time and the plays that link them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import epoch_ms_to_ts, time_parts
from ..functions.text import hash_id
from ..operators.aggregates import group_count
from ..operators.joins import first_per_key, latest_by, lookup_join, referenced_only, star_query
from ..operators.ranking import rank_bounded
from ..sources.writers import deal

# The raw schemas and the page name of a play.
EVENT_SCHEMA = (
    "artist string, auth string, firstName string, gender string, itemInSession long, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId long, song string, status long, "
    "ts long, userAgent string, userId string"
)
CATALOGUE_SCHEMA = (
    "artist_id string, artist_latitude double, artist_location string, artist_longitude double, "
    "artist_name string, duration double, num_songs int, song_id string, title string, year int"
)
PLAY_PAGE = "NextSong"

SONG_KEYS = {
    "title+artist": {"song": "title", "artist": "artist_name"},
    "title+artist+duration": {"song": "title", "artist": "artist_name", "length": "duration"},
}


def plays(events: DataFrame, precision: str = "millisecond") -> DataFrame:
    """Played events with a real start time."""
    return events.where(F.col("page") == PLAY_PAGE).withColumn("start_time", epoch_ms_to_ts("ts", precision))


def build_songs(catalogue: DataFrame) -> DataFrame:
    return first_per_key(
        catalogue.select("song_id", "title", "artist_id", "year", "duration"),
        ["song_id"],
        ["title", "artist_id", "year", "duration"],
    )


def build_artists(catalogue: DataFrame) -> DataFrame:
    renamed = catalogue.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    )
    return first_per_key(renamed, ["artist_id"], ["name", "location", "latitude", "longitude"])


def build_song_keys(catalogue: DataFrame) -> DataFrame:
    """What a lookup of plays by title and artist needs: the first song per pair."""
    columns = ["title", "artist_name", "song_id", "artist_id"]
    return first_per_key(catalogue.select(*columns), columns[:2], columns[2:])


def _user_columns(played: DataFrame, *extra: str) -> DataFrame:
    return played.select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        *extra,
    )


def build_users_latest(events: DataFrame) -> DataFrame:
    """One row per user: the profile of the last play. Equal times: later session, item."""
    played = events.where(F.col("page") == PLAY_PAGE)
    users = _user_columns(played, "ts", "sessionId", "itemInSession")
    return latest_by(
        users,
        ["user_id"],
        ["ts", "sessionId", "itemInSession", "level"],
        ["first_name", "last_name", "gender", "level"],
    )


def build_user_tuples(events: DataFrame, fact: DataFrame) -> DataFrame:
    """Every distinct profile of the users that the fact refers to."""
    played = events.where(F.col("page") == PLAY_PAGE)
    return referenced_only(_user_columns(played).distinct(), fact, {"user_id": "user_id"})


def build_time(
    events: DataFrame, only_plays: bool = False, weekday_base: str = "sunday1", dealt: bool = False
) -> DataFrame:
    """Distinct start times and their parts; ``dealt`` for a write by year and month."""
    source = events.where(F.col("page") == PLAY_PAGE) if only_plays else events
    times = source.select(epoch_ms_to_ts("ts").alias("start_time")).distinct()
    parts = time_parts("start_time", weekday_base)
    if dealt:
        months = ["year", "month"]
        times = deal(times.withColumns({c: parts[c] for c in months}), *months)
        parts |= {c: F.col(c) for c in months}
    return times.select("start_time", *[c.alias(n) for n, c in parts.items()])


def build_songplays(
    events: DataFrame,
    catalogue: DataFrame,
    key: str = "title+artist",
    normalise=F.trim,
    salts: int | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Plays with song and artist ids; unmatched plays keep null ids.

    The id is a hash of session, start time, user and item, so it is the same on
    every run. Repeated plays (same natural key) count once. ``dealt`` rebalances
    them for a write by year and month, before their ids are worked out.
    """
    on = SONG_KEYS[key]
    rules: Mapping[str, object] = {c: normalise for c in on if c != "length" and normalise is not None}
    rules = {**rules, **({"length": lambda c: c.cast("decimal(18,5)")} if "length" in on else {})}
    played = first_per_key(
        plays(events).select(
            "userId", "sessionId", "itemInSession", "start_time", "song", "artist", "length",
            "level", "location", "userAgent",
        ),
        ["userId", "sessionId", "start_time", "itemInSession"],
        ["song", "artist", "length", "level", "location", "userAgent"],
    )
    found = lookup_join(
        played, catalogue, on, {"song_id": "song_id", "artist_id": "artist_id"},
        order_by=["song_id", "artist_id"], normalise=rules, salts=salts,
    )
    found = found.select(
        "userId", "sessionId", "itemInSession", "start_time", "song_id", "artist_id", "level", "location", "userAgent",
        F.year("start_time").alias("year"), F.month("start_time").alias("month"),
    )
    if dealt:
        found = deal(found, "year", "month")
    return found.select(
        hash_id("sessionId", F.unix_micros("start_time"), "userId", "itemInSession").alias("songplay_id"),
        F.col("userId").alias("user_id"),
        "song_id",
        "artist_id",
        "start_time",
        F.col("sessionId").alias("session_id"),
        "level",
        "location",
        F.col("userAgent").alias("user_agent"),
        "year",
        "month",
    )


def level_popularity(fact: DataFrame) -> DataFrame:
    """Plays per business model, ranked. The levels are a fixed short list."""
    groups = group_count(fact.select(F.col("level").alias("business_model")), ["business_model"], "ordered")
    return rank_bounded(groups, "ordered", "rank_number").orderBy("rank_number", "business_model")


def users_by_location(fact: DataFrame) -> DataFrame:
    return group_count(
        fact.select(F.col("location").alias("user_location")), ["user_location"], "users_amount"
    ).orderBy(F.col("users_amount").desc(), "user_location")


def most_played(fact: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Plays per artist name, title and year."""
    return star_query(
        fact.where(F.col("song_id").isNotNull()).select("song_id", "artist_id", "user_id"),
        [
            (artists.select(F.col("artist_id").alias("a_id"), F.col("name").alias("artist_name")), "artist_id", "a_id", "inner"),
            (songs.select(F.col("song_id").alias("s_id"), F.col("title").alias("song_title"), F.col("year").alias("song_year")), "song_id", "s_id", "inner"),
        ],
        {"artist_name": "artist_name", "song_title": "song_title", "song_year": "song_year"},
        {"song_played_how_often": ("count", "user_id")},
    ).orderBy(F.col("song_played_how_often").desc(), "artist_name", "song_title", "song_year")
