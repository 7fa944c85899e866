"""Tables shaped for one lookup each: keyed, and stored by that key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import latest_by
from ..operators.projection import drop_empty
from ..sources.readers import scan_csv
from ..sources.writers import write_csv, write_parquet

# The columns of a daily event CSV, and those that are kept.
EVENT_CSV_SCHEMA = (
    "artist string, auth string, firstName string, gender string, itemInSession int, lastName string, "
    "length double, level string, location string, method string, page string, registration double, "
    "sessionId int, song string, status int, ts double, userId int"
)
EVENT_CSV_KEPT = (
    "artist firstName gender itemInSession lastName length level location sessionId song userId".split()
)


def stage_event_csv(spark: SparkSession, path: str | Sequence[str], target: str | None = None) -> DataFrame:
    """Daily event CSVs reduced to the kept columns of played events (artist not empty).

    A line that does not fit the columns stops the load; ``stage_csv`` can keep
    such lines apart first. With ``target`` the result is also written as CSV
    with all fields quoted, and read back from there.
    """
    played = drop_empty(scan_csv(spark, path, EVENT_CSV_SCHEMA, strict=True), "artist").select(*EVENT_CSV_KEPT)
    if target is None:
        return played
    return scan_csv(spark, write_csv(played, target, quote_all=True), played.schema, strict=True)


def build_query_table(
    rows: DataFrame,
    key: Sequence[str],
    columns: Mapping[str, Column],
    order_by: Sequence[str],
    cluster: Sequence[str] = (),
) -> DataFrame:
    """One row per full key; the last in order wins.

    ``key`` is the partition part, ``cluster`` the sort part of the primary key.
    ``LookupTable`` stores the rows by them.
    """
    full = [*key, *cluster]
    shaped = rows.withColumns(dict(columns)).select(
        *full, *[c for c in columns if c not in full], *[c for c in order_by if c not in full and c not in columns]
    )
    wanted = [c for c in columns if c not in full]
    return latest_by(shaped, full, order_by, wanted)


FOLDER = "key_folder"


@dataclass(frozen=True)
class LookupTable:
    """Rows stored for lookups by a composite key.

    ``key`` decides the folder, one of ``folders`` by hash; inside, files are
    sorted by ``key`` and ``cluster``. A lookup lists one folder and skips the
    row groups whose range does not hold the key. ``folders`` stays for the life
    of the table.
    """

    path: str
    key: tuple[str, ...]
    cluster: tuple[str, ...] = ()
    folders: int = 64

    def store(self, rows: DataFrame) -> DataFrame:
        """Write the rows in this layout and return their scan."""
        placed = rows.withColumn(FOLDER, self._folder([F.col(k) for k in self.key]))
        write_parquet(placed, self.path, [FOLDER], sort_within=[*self.key, *self.cluster])
        return self.read(rows.sparkSession)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(FOLDER)

    def get(self, spark: SparkSession, **key) -> DataFrame:
        """The rows of one key, in the order of ``cluster``."""
        if set(key) != set(self.key):
            raise ValueError(f"the key is {self.key}, got {tuple(key)}")
        stored = spark.read.parquet(self.path)
        values = {k: F.lit(key[k]).cast(stored.schema[k].dataType) for k in self.key}
        found = stored.where(F.col(FOLDER) == self._folder(list(values.values())))
        for name, value in values.items():
            found = found.where(F.col(name) == value)
        return found.drop(FOLDER).orderBy(*self.cluster) if self.cluster else found.drop(FOLDER)

    def _folder(self, columns: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.folders)).cast("int")


# Partition and sort part of the primary key of each table below.
KEYS: Mapping[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "item_by_session": (("sessionId", "itemInSession"), ()),
    "items_of_user_session": (("userId", "sessionId"), ("itemInSession",)),
    "users_by_song": (("song",), ("userId",)),
}


def lookup_table(name: str, path: str) -> LookupTable:
    return LookupTable(path, *KEYS[name])


def _order(events: DataFrame, *columns: str) -> list[str]:
    """Later rows win where the events carry a time; otherwise the values decide."""
    return [*(["ts"] if "ts" in events.columns else []), *columns]


def item_by_session(events: DataFrame) -> DataFrame:
    """Artist, song and length of an item of a session."""
    return build_query_table(
        events,
        ["sessionId", "itemInSession"],
        {"artist": F.col("artist"), "song": F.col("song"), "length": F.col("length")},
        _order(events, "artist", "song"),
    )


def items_of_user_session(events: DataFrame) -> DataFrame:
    """Artist, song and user name of a user's session, in item order."""
    return build_query_table(
        events,
        ["userId", "sessionId"],
        {
            "artist": F.col("artist"),
            "song": F.col("song"),
            "user": F.concat_ws(" ", "firstName", "lastName"),
        },
        _order(events, "artist", "song"),
        cluster=["itemInSession"],
    )


def users_by_song(events: DataFrame) -> DataFrame:
    """Every user that played a song, once."""
    return build_query_table(
        events,
        ["song"],
        {"user": F.concat_ws(" ", "firstName", "lastName")},
        _order(events, "user"),
        cluster=["userId"],
    )
