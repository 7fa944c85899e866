import pytest
from pyspark.sql import functions as F

from starforge.operators import joins


@pytest.fixture
def plays(spark):
    return spark.createDataFrame(
        [(1, " Song A ", "X"), (2, "Song A", "X"), (3, "Song B", "Y"), (4, None, "X")],
        "id int, song string, artist string",
    )


@pytest.fixture
def songs(spark):
    return spark.createDataFrame(
        [("s2", "Song A", "X"), ("s1", "Song A", "X"), ("s3", "Song C", "Y"), ("s4", None, "X")],
        "song_id string, title string, name string",
    )


KEYS = {"song": "title", "artist": "name"}


@pytest.mark.parametrize("salts", [None, 4])
def test_lookup_never_fans_out_and_takes_first_in_order(plays, songs, rows, salts):
    raw = joins.lookup_join(plays, songs, KEYS, {"song_id": "song_id"}, salts=salts)
    assert rows(raw, "id", "song_id") == [(1, None), (2, "s1"), (3, None), (4, None)]
    trimmed = joins.lookup_join(plays, songs, KEYS, {"song_id": "song_id"}, normalise=F.trim, salts=salts)
    assert rows(trimmed, "id", "song_id") == [(1, "s1"), (2, "s1"), (3, None), (4, None)]
    assert trimmed.columns == ["id", "song", "artist", "song_id"]


def test_lookup_with_unique_dim(plays, spark, rows):
    dim = spark.createDataFrame([("X", 7)], "name string, code int")
    out = joins.lookup_join(plays, dim, {"artist": "name"}, {"code": "code"}, unique=True)
    assert rows(out, "id", "code") == [(1, 7), (2, 7), (3, None), (4, 7)]


def test_salted_lookup_splits_a_hot_key(spark):
    """A key with a third of all rows: same result, and no task gets all of its rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = spark.range(30_000).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k")
        )
        dim = spark.range(500).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
        dim = dim.unionByName(spark.createDataFrame([(-1, -2)], "key long, v long"))
        plain = joins.lookup_join(fact, dim, {"k": "key"}, {"v": "v"}, unique=True)
        salted = joins.lookup_join(fact, dim, {"k": "key"}, {"v": "v"}, unique=True, salts=8)
        assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()

        def largest_task_share(df):
            hot = df.where(F.col("k") == -1).groupBy(F.spark_partition_id().alias("p")).count()
            counts = [r["count"] for r in hot.collect()]
            return max(counts) / sum(counts)

        assert largest_task_share(plain) == 1.0
        assert largest_task_share(salted) < 0.8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_keys_are_bounded(spark, rows):
    df = spark.range(1000).select(F.when(F.col("id") < 400, F.lit(0)).otherwise(F.col("id")).alias("k"))
    assert rows(joins.hot_keys(df, ["k"], 0.3)) == [(0,)]


def test_enrich_fills_missing(plays, spark, rows):
    dim = spark.createDataFrame([("X", None), ("Z", "de")], "name string, lang string")
    out = joins.enrich(plays, dim, {"artist": "name"}, {"lang": "lang"}, {"lang": "NA"})
    assert rows(out, "id", "lang") == [(1, "NA"), (2, "NA"), (3, "NA"), (4, "NA")]


def test_validate_fk_replaces_unknown_and_null(spark, rows):
    fact = spark.createDataFrame([(1, "CA"), (2, "ZZ"), (3, None)], "id int, state string")
    dim = spark.createDataFrame([("CA",), ("99",)], "code string")
    out = joins.validate_fk(fact, dim, "state", "code", "99")
    assert rows(out) == [(1, "CA"), (2, "99"), (3, "99")]
    assert joins.anti(out, dim, {"state": "code"}).isEmpty()


def test_anti_is_null_safe(spark, rows):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id int, k string")
    b = spark.createDataFrame([(None,), ("x",)], "k string")
    assert rows(joins.anti(a, b, ["k"])) == [(3, "y")]
    assert rows(joins.anti(a, b.where("k is not null"), ["k"])) == [(1, None), (3, "y")]


def test_referenced_only(spark, rows):
    dim = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, n string")
    fact = spark.createDataFrame([(1,), (1,), (9,)], "fk int")
    assert rows(joins.referenced_only(dim, fact, {"id": "fk"})) == [(1, "a")]


def test_latest_by_breaks_ties(spark, rows):
    df = spark.createDataFrame(
        [("u", 5, 1, "free"), ("u", 5, 2, "paid"), ("u", 4, 9, "old"), ("w", 1, 1, None)],
        "user string, ts int, item int, level string",
    )
    assert rows(joins.latest_by(df, ["user"], ["ts", "item"], ["level"])) == [("u", "paid"), ("w", None)]


def test_backfill(spark, rows):
    df = spark.createDataFrame([(1, "old", 5)], "id int, c string, d int")
    src = spark.createDataFrame([(1, "new")], "id int, c string")
    out = joins.backfill(df, src, "id", ["c"])
    assert out.columns == ["id", "c", "d"] and rows(out) == [(1, "new", 5)]


def test_star_query_inner_and_left(spark, rows):
    fact = spark.createDataFrame([(1, 10, 2.0), (1, 10, 3.0), (2, 99, 4.0), (7, 10, 1.0)], "a int, b int, v double")
    d1 = spark.createDataFrame([(1, "one"), (2, "two")], "a_id int, a_name string")
    d2 = spark.createDataFrame([(10, "ten")], "b int, b_name string")
    out = joins.star_query(
        fact, [(d1, "a", "a_id", "inner"), (d2, "b", "b", "left")],
        {"a_name": "a_name", "b_name": "b_name"}, {"n": ("count", "v"), "total": ("sum", "v")},
    )
    assert rows(out) == [("one", "ten", 2, 5.0), ("two", None, 1, 4.0)]
