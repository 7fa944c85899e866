from pathlib import Path

import pytest

from starforge.operators.load import BUCKET, read_upserted
from starforge.sources import scan_text
from starforge.streaming import read_staged, stream_append_new, stream_stage, stream_upsert
from starforge.streaming import jobs
from starforge.streaming.jobs import file_stream

SCHEMA = "user string, ts long, level string"


def put(folder, name, *data):
    folder.mkdir(exist_ok=True)
    text = "".join('{"user": "%s", "ts": %d, "level": "%s"}\n' % row for row in data)
    (folder / name).write_text(text)


def test_stage_takes_only_new_files(spark, tmp_path, rows):
    src, target, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "state")
    put(src, "1.json", ("a", 1, "free"))
    stream_stage(file_stream(spark, str(src), SCHEMA), target, state)
    put(src, "2.json", ("b", 2, "paid"))
    stream_stage(file_stream(spark, str(src), SCHEMA), target, state)
    stream_stage(file_stream(spark, str(src), SCHEMA), target, state)
    assert rows(spark.read.parquet(target)) == [("a", 1, "free"), ("b", 2, "paid")]


def test_append_new_keeps_late_rows_and_drops_resent_ones(spark, tmp_path, rows):
    src, target, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: stream_append_new(
        file_stream(spark, str(src), SCHEMA, files_per_trigger=1), target, ["user", "ts"], state, between=["ts"]
    )
    put(src, "1.json", ("a", 100, "free"), ("a", 100, "free"), ("b", 200, "free"))
    run()
    put(src, "2.json", ("a", 100, "free"), ("z", 1, "late"))
    put(src, "3.json", ("b", 200, "free"), ("c", 300, "paid"))
    run()
    assert rows(spark.read.parquet(target)) == [("a", 100, "free"), ("b", 200, "free"), ("c", 300, "paid"), ("z", 1, "late")]


def test_upsert_is_ordered_by_event_time(spark, tmp_path, rows):
    src, target = tmp_path / "src", str(tmp_path / "out")
    put(src, "1.json", ("a", 5, "paid"), ("b", 1, "free"))
    put(src, "2.json", ("a", 3, "free"), ("b", 2, "paid"))
    stream_upsert(
        file_stream(spark, str(src), SCHEMA, files_per_trigger=1), target, ["user"], ["ts"], str(tmp_path / "state"), buckets=4
    )
    assert rows(read_upserted(spark, target).drop(BUCKET)) == [("a", 5, "paid"), ("b", 2, "paid")]


def spoiled(folder, name, *data):
    put(folder, name, *data)
    with (folder / name).open("a") as file:
        file.write('{bad %s\n{"user": "x", "ts": "soon"}\n' % name)


def test_a_bad_line_stops_the_stream(spark, tmp_path):
    src, target = tmp_path / "src", str(tmp_path / "out")
    spoiled(src, "1.json", ("a", 1, "free"))
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        stream_stage(file_stream(spark, str(src), SCHEMA), target, str(tmp_path / "state"))
    with pytest.raises(ValueError):
        stream_stage(file_stream(spark, str(src), SCHEMA, mark_bad=True), target, str(tmp_path / "other"))


def rerun_last_batch(state, n):
    """As after a failure between the sinks and the commit."""
    for name in (f"{n}", f".{n}.crc"):
        (Path(state) / "commits" / name).unlink()


def test_bad_lines_are_kept_apart_and_a_batch_that_runs_again_adds_nothing(spark, tmp_path, rows):
    src, target, bad, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "state")
    run = lambda: stream_stage(file_stream(spark, str(src), SCHEMA, mark_bad=True), target, state, bad)
    spoiled(src, "1.json", ("a", 1, "free"))
    run()
    spoiled(src, "2.json", ("b", 2, "paid"))
    run()
    for _ in range(2):
        assert rows(read_staged(spark, target)) == [("a", 1, "free"), ("b", 2, "paid")]
        ill = '{"user": "x", "ts": "soon"}'
        assert rows(read_staged(spark, bad, "text")) == [(ill,), (ill,), ("{bad 1.json",), ("{bad 2.json",)]
        rerun_last_batch(state, 1)
        run()


def test_a_batch_that_died_between_the_sinks_is_made_whole(spark, tmp_path, rows, monkeypatch):
    src, target, bad, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "state")
    run = lambda: stream_stage(file_stream(spark, str(src), SCHEMA, mark_bad=True), target, state, bad)
    spoiled(src, "1.json", ("a", 1, "free"))

    def dies(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(jobs, "write_parquet", dies)
        with pytest.raises(Exception, match="driver lost"):
            run()
    assert scan_text(spark, f"{bad}/*").count() == 2
    run()
    assert rows(read_staged(spark, target)) == [("a", 1, "free")] and read_staged(spark, bad, "text").count() == 2


def test_streams_of_other_checkpoints_do_not_replace_each_other(spark, tmp_path):
    target, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for name in "ab":
        spoiled(tmp_path / name, "1.json", (name, 1, "free"))
        stream_stage(file_stream(spark, str(tmp_path / name), SCHEMA, mark_bad=True), target, str(tmp_path / f"s{name}"), bad)
    assert read_staged(spark, target).count() == 2 and read_staged(spark, bad, "text").count() == 4


def test_facts_and_profiles_keep_bad_lines_apart(spark, tmp_path, rows):
    src = tmp_path / "src"
    spoiled(src, "1.json", ("a", 1, "free"), ("a", 2, "paid"))
    stream = lambda: file_stream(spark, str(src), SCHEMA, mark_bad=True)
    facts, profiles = str(tmp_path / "facts"), str(tmp_path / "profiles")
    stream_append_new(stream(), facts, ["user", "ts"], str(tmp_path / "s1"), bad_records=str(tmp_path / "b1"))
    stream_upsert(stream(), profiles, ["user"], ["ts"], str(tmp_path / "s2"), buckets=2, bad_records=str(tmp_path / "b2"))
    assert rows(spark.read.parquet(facts)) == [("a", 1, "free"), ("a", 2, "paid")]
    assert rows(read_upserted(spark, profiles).drop(BUCKET)) == [("a", 2, "paid")]
    assert [read_staged(spark, str(tmp_path / b), "text").count() for b in ("b1", "b2")] == [2, 2]
