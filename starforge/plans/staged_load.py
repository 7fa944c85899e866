"""Stage, fact, dimensions, checks: the order of a scheduled load in one application."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.load import LoadStats, append_new, load, stats_frame
from ..operators.quality import dq_report
from ..session import discard, materialise, path_exists, sparing_disk
from ..sources.staging import check_mode
from . import songplay

KEY_COLUMNS = {
    "f_songplays": ["songplay_id", "user_id", "start_time", "level"],
    "d_users": ["user_id", "level"],
    "d_songs": ["song_id", "artist_id"],
    "d_artists": ["artist_id"],
    "d_time": ["start_time"],
}


@dataclass
class StagedLoad:
    """Named steps in groups. Steps of one group do not depend on each other and
    run as concurrent Spark jobs; the groups run in order."""

    spark: SparkSession
    stats: dict[str, LoadStats] = field(default_factory=dict)

    def run(self, *groups: Sequence[tuple[str, Callable[[], LoadStats]]]) -> DataFrame:
        for group in groups:
            with ThreadPoolExecutor(max_workers=len(group)) as pool:
                jobs = [(name, pool.submit(step)) for name, step in group]
                for name, job in jobs:
                    self.stats[name] = job.result()
        return stats_frame(self.spark, self.stats)


FACT_MODES = ("append_new", "append_only", "truncate_load")


def load_songplay_star(
    events: DataFrame,
    catalogue: DataFrame,
    root: str,
    staging_mode: str = "truncate_load",
    fact_mode: str = "append_new",
    dim_mode: str = "truncate_load",
) -> tuple[DataFrame, DataFrame]:
    """Load the songplay star below ``root``; returns load counts and the quality report.

    Facts: ``append_new`` adds unknown plays only, ``append_only`` adds all,
    ``truncate_load`` replaces. Dimensions: ``truncate_load`` rebuilds,
    ``append_only`` inserts unknown members only.
    """
    check_mode(staging_mode)
    check_mode(dim_mode)
    if fact_mode not in FACT_MODES:
        raise ValueError(f"fact mode must be one of {FACT_MODES}, got {fact_mode!r}")
    spark = events.sparkSession

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}")

    def staging(name: str, rows: DataFrame):
        return name, lambda: load(rows, f"{root}/{name}", staging_mode)

    def fact() -> LoadStats:
        target = f"{root}/f_songplays"
        # New plays are compared with the known ones before they are dealt.
        dealt = fact_mode != "append_new" or not path_exists(spark, target)
        # Written first, so that its size is known before the plays are shuffled for the lookup.
        keys = materialise(songplay.build_song_keys(table("staging_songs")), "song-keys")
        rows = songplay.build_songplays(table("staging_events"), keys, dealt=dealt)
        try:
            if fact_mode == "append_new":
                # A play is in the batch once, and the id is a hash of what tells plays apart.
                return append_new(
                    target, rows, ["songplay_id", "start_time"],
                    partition_by=["year", "month"], between=["year", "start_time"], unique=True, dealt=dealt,
                )
            return load(rows, target, fact_mode, ["year", "month"], dealt)
        finally:
            discard(keys)

    def dim(
        name: str, key: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = (), dealt: bool = False
    ):
        def step() -> LoadStats:
            if dim_mode == "append_only":
                return append_new(f"{root}/{name}", build(), [key], partition_by=partition_by)
            return load(build(), f"{root}/{name}", dim_mode, partition_by, dealt)

        return name, step

    with sparing_disk(spark):
        counts = StagedLoad(spark).run(
            [staging("staging_events", events), staging("staging_songs", catalogue)],
            [("f_songplays", fact)],
            [
                dim("d_users", "user_id", lambda: songplay.build_users_latest(table("staging_events"))),
                dim("d_songs", "song_id", lambda: songplay.build_songs(table("staging_songs")), ["year"]),
                dim("d_artists", "artist_id", lambda: songplay.build_artists(table("staging_songs"))),
                dim(
                    "d_time", "start_time",
                    lambda: songplay.build_time(
                        table("staging_events"), only_plays=True, dealt=dim_mode != "append_only"
                    ),
                    ["year", "month"], dim_mode != "append_only",
                ),
            ],
        )
    report = dq_report({name: (table(name), columns) for name, columns in KEY_COLUMNS.items()})
    return counts, report
