"""What a load leaves on disk: no shuffle files of ended queries, no needless shuffle."""

import glob
import time

import pytest
from pyspark.sql import functions as F

from starforge.operators.quality import DataQualityError
from starforge.plans import songplay, staged_load
from starforge.plans.publish import STAR_RULES, load_audited_star
from starforge.session import LOAD_SETTINGS, sparing_disk
from starforge.workload import raw
from starforge.workload.registry import Tables


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def left_by(spark, run):
    """The shuffle files that ``run`` leaves, once deletions under way have ended."""
    before = shuffle_files(spark)
    run()
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


@pytest.fixture
def events(spark, tmp_path):
    rows = spark.range(400).selectExpr(
        "concat('artist ', id % 5) AS artist", "'Logged In' AS auth", "'Ann' AS firstName", "'F' AS gender", "id % 7 AS itemInSession",
        "'Lee' AS lastName", "200.5D AS length", "'free' AS level", "'Reno' AS location", "'PUT' AS method", "'NextSong' AS page",
        "1.5e12D AS registration", "id DIV 7 AS sessionId", "concat('song ', id % 3) AS song", "200L AS status",
        "1541105830796 + id AS ts", "'UA' AS userAgent", "cast(id % 11 AS string) AS userId",
    )
    rows.repartition(3).write.parquet(str(tmp_path / "log"))
    return spark.read.parquet(str(tmp_path / "log"))


@pytest.fixture
def songs(spark):
    return spark.range(6000).selectExpr(
        "concat('A', id % 5) AS artist_id", "1D AS artist_latitude", "'NV' AS artist_location", "1D AS artist_longitude",
        "concat('artist ', id % 5) AS artist_name", "200.5D AS duration", "1 AS num_songs", "concat('S', 10000 + id) AS song_id",
        "concat('song ', id % 3, if(id % 2 = 0, ' ', '')) AS title", "1999 AS year",
    )


def test_a_load_leaves_no_shuffle_files(spark, events, songs, tmp_path):
    before = {key: spark.conf.get(key) for key in LOAD_SETTINGS}
    assert not left_by(spark, lambda: staged_load.load_songplay_star(events, songs, str(tmp_path / "star")))
    assert {key: spark.conf.get(key) for key in LOAD_SETTINGS} == before
    assert glob.glob(str(tmp_path / "star/f_songplays/*/*/*.zstd.parquet"))
    fact = spark.read.parquet(str(tmp_path / "star/f_songplays"))
    want = songplay.build_songplays(events, songs)
    assert fact.count() == 400 and fact.select(want.columns).exceptAll(want).isEmpty()


def test_an_audited_load_leaves_no_shuffle_files(spark, events, songs, tmp_path):
    def runs():
        load_audited_star(events, songs, str(tmp_path), "one", "disk_", STAR_RULES)
        with pytest.raises(DataQualityError):
            load_audited_star(events.withColumn("level", F.lit("")), songs, str(tmp_path), "two", "disk_", STAR_RULES)

    assert not left_by(spark, runs)
    for name in staged_load.KEY_COLUMNS:
        spark.sql(f"DROP VIEW disk_{name}")


def test_settings_hold_again_after_a_load_that_died(spark):
    before = {key: spark.conf.get(key) for key in LOAD_SETTINGS}
    with pytest.raises(OSError), sparing_disk(spark):
        assert {key: spark.conf.get(key) for key in LOAD_SETTINGS} == LOAD_SETTINGS
        raise OSError("driver lost")
    assert {key: spark.conf.get(key) for key in LOAD_SETTINGS} == before


def test_plays_are_not_shuffled_for_a_lookup_of_few_songs(spark, events, songs, tmp_path, monkeypatch, plan):
    """The catalogue is too large to be broadcast, its titles and artists are few."""
    written = {}
    keep = staged_load.append_new

    def spy(target, rows, *args, **kwargs):
        written[target.split("/")[-1]] = plan(rows)
        return keep(target, rows, *args, **kwargs)

    monkeypatch.setattr(staged_load, "append_new", spy)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "20000")
    try:
        staged_load.load_songplay_star(events, songs, str(tmp_path / "star"))
    finally:
        spark.conf.set(threshold, before)
    assert "BroadcastHashJoin" in written["f_songplays"] and "SortMergeJoin" not in written["f_songplays"]


def test_song_keys_change_no_lookup(spark, events):
    odd = [("song 1", "artist 1", "S2", "A2"), (" song 1", "artist 1", "S1", "A9"), ("song 1", "artist 1", "S1", "A1"),
           ("song 2", "artist 2", None, "A3"), ("song 2 ", "artist 2", "S0", None), (None, "artist 0", "S5", "A5"),
           ("song 0", "artist 0", "S6", None), ("song 0", "artist 0", "S6", "A6")]
    catalogue = spark.createDataFrame(odd, "title string, artist_name string, song_id string, artist_id string")
    keys = songplay.build_song_keys(catalogue)
    assert keys.count() == 6
    want = songplay.build_songplays(events, catalogue)
    assert songplay.build_songplays(events, keys).exceptAll(want).isEmpty() and want.count() == 400


def test_line_items_are_shuffled_before_they_are_wide(spark, tmp_path, plan):
    """By part and by order: the buyers' columns join the orders, not the line items."""
    spark.createDataFrame([(1, 1, 1, 1, "N", "O")], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                          "l_returnflag string, l_linestatus string").selectExpr("*", "timestamp_ntz'1996-09-13' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")  # fmt: skip
    spark.sql("SELECT 1L AS o_orderkey, 1L AS o_custkey, timestamp_ntz'1996-09-01' AS o_orderdate, '5-LOW' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 1L AS c_custkey, 'C' AS c_name, 1 AS c_nationkey, 5D AS c_acctbal, 'B' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 1L AS p_partkey, 'red rod' AS p_name, 9D AS p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT 1L AS s_suppkey, 'S' AS s_name").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'PERU' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    log = raw.event_log(Tables(spark, str(tmp_path)))
    r = log.first()
    assert (r.artist, r.song, r.level, r.page, r.location, r.userId, r.itemInSession) == ("S", "red rod  ", "paid", "NextSong", "PERU", "1", 1)
    assert r.ts == 842572800000 + 1001
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        joins = [line for line in plan(raw.event_log(Tables(spark, str(tmp_path)))).split("\n") if "SortMergeJoin" in line]
    finally:
        spark.conf.set(threshold, before)
    # The outermost join is the one by order.
    assert "[l_orderkey" in joins[0] and "[o_orderkey" in joins[0] and len(joins) == 5
