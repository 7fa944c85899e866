"""Audit before publishing: readers see tables through views, which are pointed at
a new load only when its checks have passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.quality import DataQualityError, orphans
from ..session import sparing_disk
from . import staged_load

# A rule looks at all tables of a candidate; its rows have table_name and status.
Rule = Callable[[Mapping[str, DataFrame]], DataFrame]


def _quoted(path: str) -> str:
    return "`" + path.replace("`", "``") + "`"


def publish_views(spark: SparkSession, folders: Mapping[str, str]) -> None:
    """Point every view (key) at the Parquet folder named for it.

    Views are swapped one after the other; if one cannot be, those swapped before
    are put back, so readers keep tables of one load.
    """
    before = {name: published_folder(spark, name) for name in folders}
    done: list[str] = []
    try:
        for name, folder in folders.items():
            _point(spark, name, folder)
            done.append(name)
    except Exception:
        for name in done:
            if before[name] is None:
                spark.sql(f"DROP VIEW IF EXISTS {name}")
            else:
                _point(spark, name, before[name])
        raise


FOLDER_PROPERTY = "published_folder"


def _point(spark: SparkSession, name: str, folder: str) -> None:
    kept = folder.replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{FOLDER_PROPERTY}' = '{kept}') "
        f"AS SELECT * FROM parquet.{_quoted(folder)}"
    )


def published_folder(spark: SparkSession, name: str) -> str | None:
    """The folder that a published view reads, None before the first publication."""
    if not spark.catalog.tableExists(name):
        return None
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return kept.get(FOLDER_PROPERTY)


def audit(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """The rows of all rules; raises ``DataQualityError`` if a status is not OK.

    A rule gives a row per table or column, so the driver sees a short report.
    """
    spark = next(iter(tables.values())).sparkSession
    found = [r.asDict() for rule in rules for r in rule(tables).collect()]
    failed = [r for r in found if r["status"] != "OK"]
    if failed:
        raise DataQualityError(failed)
    report = [{"table_name": r["table_name"], "entries": r.get("entries"), "status": r["status"]} for r in found]
    return spark.createDataFrame(report, "table_name string, entries long, status string")


def no_orphans(fact: str, dim: str, key: str) -> Rule:
    """Every non-null ``key`` of the fact is a member of the dim."""

    def rule(tables: Mapping[str, DataFrame]) -> DataFrame:
        lost = orphans(tables[fact], tables[dim], key, key).agg(F.count(F.lit(1)).alias("entries"))
        status = F.when(F.col("entries") == 0, "OK").otherwise("NOK")
        return lost.select(F.lit(f"{fact}.{key}").alias("table_name"), "entries", status.alias("status"))

    return rule


def load_audited_star(
    events: DataFrame,
    catalogue: DataFrame,
    root: str,
    load_id: str,
    prefix: str,
    rules: Sequence[Rule] = (),
) -> DataFrame:
    """Build the songplay star in ``root/load_id``, check it and point the views
    ``<prefix><table>`` at it; returns the report.

    A load that fails a check raises ``DataQualityError``; its folder stays to be
    looked into and the views stay on the last good load. A load that is repeated
    under its id starts anew. Folders of older loads are the caller's to drop.
    """
    spark = events.sparkSession
    folder = f"{root}/{load_id}"
    names = list(staged_load.KEY_COLUMNS)
    current = [published_folder(spark, prefix + name) for name in names]
    if any(path == f"{folder}/{name}" for name, path in zip(names, current)):
        raise ValueError(f"load {load_id!r} is published, build the next one under an id of its own")
    with sparing_disk(spark):
        _, report = staged_load.load_songplay_star(events, catalogue, folder, fact_mode="truncate_load")
        tables = {name: spark.read.parquet(f"{folder}/{name}") for name in names}
        found = audit(tables, [lambda _: report, *rules])
    publish_views(spark, {prefix + name: f"{folder}/{name}" for name in names})
    return found


STAR_RULES = (
    no_orphans("f_songplays", "d_users", "user_id"),
    no_orphans("f_songplays", "d_songs", "song_id"),
    no_orphans("f_songplays", "d_artists", "artist_id"),
)
