from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starforge.operators import load


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "table")


def users(spark, *data):
    return spark.createDataFrame(list(data), "id int, ts int, level string")


def test_truncate_and_append(spark, target, rows):
    assert load.load(spark.range(3), target, "truncate_load") == (0, 3, 3)
    assert load.load(spark.range(2), target, "append_only") == (3, 5, 2)
    assert load.load(spark.range(4), target, "truncate_load") == (5, 4, 4)
    assert rows(spark.read.parquet(target)) == [(0,), (1,), (2,), (3,)]


def test_unknown_mode(spark, target):
    with pytest.raises(ValueError):
        load.load(spark.range(1), target, "merge")


def test_insert_ignore_first_wins_and_is_idempotent(spark, target, rows):
    batch = users(spark, (1, 2, "b"), (1, 1, "a"), (2, 1, "x"))
    assert load.insert_ignore(target, batch, ["id"], ["ts"]).inserted == 2
    assert load.insert_ignore(target, batch, ["id"], ["ts"]).inserted == 0
    assert load.insert_ignore(target, users(spark, (1, 0, "late"), (3, 1, "n")), ["id"], ["ts"]).inserted == 1
    assert rows(spark.read.parquet(target)) == [(1, 1, "a"), (2, 1, "x"), (3, 1, "n")]


def test_append_new_takes_new_plays_of_known_users(spark, target, rows):
    load.append_new(target, users(spark, (1, 10, "free")), ["id", "ts"], between=["ts"])
    stats = load.append_new(target, users(spark, (1, 10, "free"), (1, 20, "free")), ["id", "ts"], between=["ts"])
    assert stats == (1, 2, 1)
    assert load.append_new(target, users(spark, (1, 20, "free")), ["id", "ts"], between=["ts"]).inserted == 0


def test_append_new_with_null_key(spark, target):
    batch = spark.createDataFrame([(None, "a"), (1, "b")], "id int, v string")
    assert load.append_new(target, batch, ["id"], between=["id"]).inserted == 2
    assert load.append_new(target, batch, ["id"], between=["id"]).inserted == 0


def test_append_new_partitioned(spark, target):
    batch = users(spark, *[(i, i % 5, "x") for i in range(50)])
    assert load.append_new(target, batch, ["id", "ts"], partition_by=["ts"], between=["ts"]).inserted == 50
    more = users(spark, *[(i, i % 5, "x") for i in range(60)])
    assert load.append_new(target, more, ["id", "ts"], partition_by=["ts"], between=["ts"]).inserted == 10


def test_upsert_last_wins_in_any_batch_order(spark, target, rows):
    load.upsert(target, users(spark, (1, 5, "paid"), (1, 3, "free"), (2, 1, "free")), ["id"], ["ts"], buckets=4)
    late = load.upsert(target, users(spark, (1, 4, "late"), (2, 2, "paid"), (3, 1, "new")), ["id"], ["ts"], buckets=4)
    assert late == (2, 3, 1)
    equal = users(spark, (1, 5, "batch"))
    load.upsert(target, equal, ["id"], ["ts"], buckets=4)
    assert load.upsert(target, equal, ["id"], ["ts"], buckets=4).inserted == 0
    got = rows(load.read_upserted(spark, target), "id", "ts", "level")
    assert got == [(1, 5, "batch"), (2, 2, "paid"), (3, 1, "new")]


def test_upsert_leaves_untouched_folders_alone(spark, target):
    load.upsert(target, users(spark, *[(i, 1, "a") for i in range(200)]), ["id"], ["ts"], buckets=8)
    files = lambda: {
        r.p: r.b for r in load.read_upserted(spark, target).select(
            F.col("_metadata.file_path").alias("p"), load.BUCKET).withColumnRenamed(load.BUCKET, "b").distinct().collect()
    }
    before = files()
    load.upsert(target, users(spark, (7, 2, "b")), ["id"], ["ts"], buckets=8)
    after = files()
    kept = [p for p in before if p in after]
    assert len({after[p] for p in kept}) == 7 and load.read_upserted(spark, target).count() == 200
    assert len(load.drop_superseded(spark, target)) == 1 and load.read_upserted(spark, target).count() == 200


def test_upsert_that_died_leaves_the_last_state(spark, target, rows, monkeypatch):
    load.upsert(target, users(spark, (1, 1, "a"), (2, 1, "b")), ["id"], ["ts"], buckets=2)
    write = load.write_parquet

    def dies(df, path, *args, **kwargs):
        write(df, path, *args, **kwargs)
        raise OSError("driver lost")

    monkeypatch.setattr(load, "write_parquet", dies)
    with pytest.raises(OSError):
        load.upsert(target, users(spark, (1, 2, "x"), (3, 1, "c")), ["id"], ["ts"], buckets=2)
    assert rows(load.read_upserted(spark, target), "id", "ts", "level") == [(1, 1, "a"), (2, 1, "b")]
    monkeypatch.setattr(load, "write_parquet", write)
    assert load.upsert(target, users(spark, (1, 2, "x"), (3, 1, "c")), ["id"], ["ts"], buckets=2).inserted == 1
    assert rows(load.read_upserted(spark, target), "id", "level") == [(1, "x"), (2, "b"), (3, "c")]


def test_uncounted_loads_return_no_numbers(spark, target):
    assert load.append_new(target, spark.range(3), ["id"], counted=False) == (None, None, None)
    assert load.row_count(spark, target) == 3


def test_stats_frame(spark, rows):
    frame = load.stats_frame(spark, {"d": load.LoadStats(1, 3, 2)})
    assert rows(frame) == [("d", 1, 3, 2)]


def test_loads_count_what_they_write_and_nothing_else(spark, target, monkeypatch):
    load.load(spark.range(10), target, "append_only")

    def counts(self):
        raise AssertionError("a job that only counts")

    monkeypatch.setattr(type(spark.range(1)), "count", counts)
    assert load.load(spark.range(5), target, "append_only") == (10, 15, 5)
    assert load.append_new(target, spark.range(12), ["id"]) == (15, 17, 2)
    assert load.append_new(target, spark.range(12), ["id"], between=["id"]) == (17, 17, 0)
    assert load.load(spark.range(0), target, "append_only") == (17, 17, 0)
    assert load.load(spark.range(4), target, "truncate_load") == (17, 4, 4)
    monkeypatch.undo()
    assert spark.read.parquet(target).count() == 4


def test_a_note_is_not_believed_when_the_files_have_changed(spark, target):
    load.load(spark.range(10), target, "append_only")
    spark.range(7).write.mode("append").parquet(target)
    assert load.noted_rows(spark, target) is None and load.row_count(spark, target) == 17
    assert load.append_new(target, spark.range(20), ["id"]) == (17, 27, 10)
    assert load.noted_rows(spark, target) == 27


def test_partitioned_loads_are_counted_too(spark, target):
    rows = spark.range(20).withColumn("p", F.col("id") % 3)
    assert load.load(rows, target, "truncate_load", ["p"]) == (0, 20, 20)
    assert load.append_new(target, rows.where("id < 5"), ["id"], partition_by=["p"]).inserted == 0


def test_dropping_superseded_folders_keeps_one_listing(spark, target):
    for n in range(3):
        load.upsert(target, users(spark, (1, n, "a"), (2 + n, n, "b")), ["id"], ["ts"], buckets=2, counted=False)
    load.drop_superseded(spark, target)
    listings = [s.name for s in Path(target, "_states").iterdir() if not s.name.startswith(".")]
    assert listings == ["3"] and load.read_upserted(spark, target).count() == 4
