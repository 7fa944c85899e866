import datetime as dt
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starforge import sources
from starforge.session import clear_scratch, path_exists, scratch_path, shared_dir


def test_json_schema_needs_no_inference_and_nested_is_inferred(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('{"id": 1, "ts": 5, "extra": "x"}\n{"id": 2}\n')
    typed = sources.scan_json(spark, str(tmp_path), "id int, ts long")
    assert rows(typed) == [(1, 5), (2, None)]
    (tmp_path / "n.json").write_text('{"fields": {"city": "Reno", "age": 30.5}}\n')
    nested = sources.scan_json(spark, str(tmp_path / "n.json"))
    assert rows(nested.select("fields.city", "fields.age")) == [("Reno", 30.5)]


def test_recursive_walk_takes_json_only(spark, tmp_path, rows):
    for folder, name, text in (("A/B", "x.json", '{"id": 1}'), ("A/C/D", "y.json", '{"id": 2}'), ("A", "z.txt", '{"id": 3}')):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_text(text + "\n")
    found = sources.scan_json(spark, str(tmp_path), "id int", recursive=True, with_file=True)
    assert [(i, Path(f).name) for i, f in rows(found)] == [(1, "x.json"), (2, "y.json")]


def test_csv_with_quoted_commas_and_float_times(spark, tmp_path, rows):
    (tmp_path / "d1.csv").write_text('artist,location,ts\n"A, B","Reno, NV",1.54111E+12\n,,1.54112E+12\n')
    (tmp_path / "d2.csv").write_text('artist,location,ts\nC,"He said ""hi""",1.54113E+12\n')
    got = sources.scan_csv(spark, [str(tmp_path / "d1.csv"), str(tmp_path / "d2.csv")], "artist string, location string, ts double")
    assert rows(got.where("artist is not null")) == [("A, B", "Reno, NV", 1.54111e12), ("C", 'He said "hi"', 1.54113e12)]


def test_csv_sink_quotes_all(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c')], "id int, v string")
    out = sources.write_csv(df.coalesce(1), str(tmp_path / "q"), quote_all=True)
    part = next(Path(out).glob("part-*.csv"))
    assert part.read_text().splitlines() == ['"id","v"', '"1","a ""b"", c"']
    zipped = sources.write_csv(df.coalesce(1), str(tmp_path / "z"), compression="gzip")
    assert gzip.open(next(Path(zipped).glob("part-*.csv.gz")), "rt").readline() == "id,v\n"


def test_json_export_is_plain_objects(spark, tmp_path):
    out = sources.write_json(spark.createDataFrame([(1, None)], "id int, v string").coalesce(1), str(tmp_path / "j"))
    assert next(Path(out).glob("part-*.json")).read_text() == '{"id":1,"v":null}\n'


def test_text_lines(spark, tmp_path, rows):
    (tmp_path / "t.txt").write_text("one\n\n  two\n")
    assert rows(sources.scan_text(spark, str(tmp_path / "t.txt"))) == [("  two",), ("",), ("one",)]


def test_partition_pruning_reads_selected_folders_only(spark, tmp_path, rows, plan):
    df = spark.range(100).withColumn("month", (F.col("id") % 4).cast("int"))
    path = sources.write_parquet(df, str(tmp_path / "p"), ["month"])
    picked = sources.scan_parquet(spark, path, {"month": [1, 2]})
    assert picked.count() == 50
    assert "PartitionFilters: [month" in plan(picked)
    assert "PushedFilters: [GreaterThan(id,90)]" in plan(picked.where("id > 90")).replace("IsNotNull(id), ", "")


def test_write_parquet_puts_a_partition_into_one_file(spark, tmp_path):
    df = spark.range(1000, numPartitions=8).withColumn("m", (F.col("id") % 3).cast("int"))
    path = sources.write_parquet(df, str(tmp_path / "w"), ["m"], sort_within=["id"], compression="gzip")
    assert len(list(Path(path).glob("m=*/*.parquet"))) == 3


def test_stage_json_modes_and_mapping(spark, tmp_path, rows):
    (tmp_path / "e.json").write_text('{"user": {"id": "7"}, "n": "x"}\n')
    mapping = {"user_id": ("$.user.id", "int"), "n": ("$.n", "string"), "gone": ("$.user.at.x", "string")}
    target = str(tmp_path / "staged")
    assert rows(sources.stage_json(spark, str(tmp_path / "e.json"), target, mapping=mapping)) == [(7, "x", None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sources.stage_json(spark, str(tmp_path / "e.json"), str(tmp_path / "other"), mapping={"n": ("$.n", "int")})
    appended = sources.stage_json(spark, str(tmp_path / "e.json"), target, mapping=mapping, mode="append_only")
    assert appended.count() == 2
    with pytest.raises(ValueError):
        sources.stage_json(spark, str(tmp_path / "e.json"), target, mapping=mapping, mode="replace")


def test_stage_dates_takes_existing_days(spark, tmp_path, rows):
    for day in ("2018-11-01", "2018-11-03"):
        (tmp_path / f"{day}-events.json").write_text('{"d": "%s"}\n' % day)
    template = str(tmp_path / "{date:%Y}-{date:%m}-{date:%d}-events.json")
    days = (dt.date(2018, 11, 1), dt.date(2018, 11, 30))
    with pytest.raises(FileNotFoundError, match="28 of 30"):
        sources.stage_dates(spark, template, *days, str(tmp_path / "s"), "d string")
    assert len(sources.missing_paths(spark, sources.dated_paths(template, *days))) == 28
    staged = sources.stage_dates(spark, template, *days, str(tmp_path / "s"), "d string", allow_missing=True)
    assert rows(staged) == [("2018-11-01",), ("2018-11-03",)]
    with pytest.raises(FileNotFoundError):
        sources.stage_dates(spark, template, dt.date(2019, 1, 1), dt.date(2019, 1, 2), str(tmp_path / "s"), "d string")


def test_ingest_slices_skips_done_and_redoes_unfinished(spark, tmp_path):
    target, calls = str(tmp_path / "i"), []

    def build(name):
        def inner():
            calls.append(name)
            return spark.range(3).withColumn("m", F.lit(1))
        return inner

    slices = {"jan": build("jan"), "feb": build("feb")}
    assert sources.ingest_slices(spark, slices, target, ["m"]) == ["jan", "feb"]
    assert sources.ingest_slices(spark, slices, target, ["m"]) == []
    Path(target, "slice=feb", "_SUCCESS").unlink()
    assert sources.ingest_slices(spark, slices, target, ["m"]) == ["feb"]
    assert calls == ["jan", "feb", "feb"] and spark.read.parquet(target).count() == 6


def test_tables_and_views(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sources.ensure_table(spark, "made", df.schema, str(tmp_path / "made"))
    sources.ensure_table(spark, "made", df.schema)
    df.write.insertInto("made")
    assert spark.table("made").count() == 1
    sources.drop_table(spark, "made")
    sources.drop_table(spark, "made")
    assert not spark.catalog.tableExists("made")
    sources.ensure_table(spark, "managed", df.schema)
    df.write.insertInto("managed")
    sources.truncate_table(spark, "managed")
    assert spark.table("managed").count() == 0
    sources.drop_table(spark, "managed")
    assert sources.save_table(df, "kept", ["v"], path=str(tmp_path / "kept")).count() == 1
    sources.register(df, "seen")
    assert spark.sql("select count(*) from seen").first()[0] == 1


def test_manifest(spark, tmp_path):
    path = sources.write_parquet(spark.range(5).coalesce(1), str(tmp_path / "m"))
    files = sources.file_manifest(spark, path, "*.parquet").collect()
    assert len(files) == 1 and files[0].length > 0


def test_shared_folder_is_the_configured_one(spark, tmp_path, monkeypatch):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr("starforge.session.shared_dir", lambda s: str(tmp_path))
    path = scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    assert path != scratch_path(spark, "x") and path_exists(spark, path)
    clear_scratch(spark)
    assert not path_exists(spark, path)


def test_json_paths():
    assert sources.parse_json_path("$.a['b c'][\"d.e\"][2].f") == ["a", "b c", "d.e", 2, "f"]
    for bad in ("a.b", "$", "$.*", "$..a", "$.a[*]", "$[0].a", "$.a[?(@.b)]", "$.a.", "$.a b"):
        with pytest.raises(ValueError):
            sources.parse_json_path(bad)


def test_json_paths_that_contradict_each_other(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"a": {"b": 1}}\n')
    for paths in (("$.a", "$.a.b"), ("$.a.b", "$.a"), ("$.a[0]", "$.a.b")):
        mapping = {f"c{i}": (p, "string") for i, p in enumerate(paths)}
        with pytest.raises(ValueError):
            sources.stage_json(spark, str(tmp_path / "e.json"), str(tmp_path / "s"), mapping=mapping)


def test_bad_lines_stop_the_load_or_are_kept_apart(spark, tmp_path, rows):
    (tmp_path / "e.json").write_text('{"a": 1, "b": "x"}\n{"a": \n{"a": "one", "b": "y"}\n\n')
    source, target, bad = str(tmp_path / "e.json"), str(tmp_path / "s"), str(tmp_path / "bad")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        sources.stage_json(spark, source, target, schema="a int, b string")
    assert rows(sources.stage_json(spark, source, target, schema="a int, b string", bad_records=bad)) == [(1, "x")]
    assert rows(sources.scan_text(spark, bad)) == [('{"a": "one", "b": "y"}',), ('{"a": ',)]
    mapping = {"a": ("$.a", "int"), "b": ("$['b']", "string")}
    assert rows(sources.stage_json(spark, source, target, mapping=mapping, bad_records=bad)) == [(1, "x")]
    assert sources.scan_text(spark, bad).count() == 2


def test_rejects_follow_the_mode_of_the_load(spark, tmp_path, rows):
    target, bad = str(tmp_path / "s"), str(tmp_path / "bad")
    for i, name in enumerate("ab"):
        (tmp_path / f"{name}.json").write_text('{"a": %d}\n{"a": "%s"}\n' % (i, name))

    def stage(name, mode):
        return sources.stage_json(spark, str(tmp_path / f"{name}.json"), target, schema="a int", mode=mode, bad_records=bad)

    stage("a", "append_only")
    assert rows(stage("b", "append_only")) == [(0,), (1,)]
    assert rows(sources.scan_text(spark, bad)) == [('{"a": "a"}',), ('{"a": "b"}',)]
    assert rows(stage("b", "truncate_load")) == [(1,)]
    assert rows(sources.scan_text(spark, bad)) == [('{"a": "b"}',)]


def test_csv_bad_lines_stop_the_scan_or_are_marked_or_kept_apart(spark, tmp_path, rows):
    (tmp_path / "c.csv").write_text('id,name,n\n1,"a, b",2\n2,short\n3,c,many\n4,d,5,6\n')
    path, schema = str(tmp_path / "c.csv"), "id int, name string, n int"
    assert sources.scan_csv(spark, path, schema).where("n is null").count() == 2
    for ask in (lambda df: df.collect(), lambda df: df.select("id").collect()):
        with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
            ask(sources.scan_csv(spark, path, schema, strict=True))
    marked = sources.scan_csv(spark, path, schema, mark_bad=True)
    assert rows(marked.where("_bad_line is null").drop("_bad_line")) == [(1, "a, b", 2)]
    target, bad = str(tmp_path / "t"), str(tmp_path / "bad")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        sources.stage_csv(spark, path, target, schema)
    assert not path_exists(spark, f"{target}/_SUCCESS")
    for n in (1, 2):
        staged = sources.stage_csv(spark, path, target, schema, mode="append_only", bad_records=bad)
        assert rows(staged) == [(1, "a, b", 2)] * n
        assert rows(sources.scan_text(spark, bad)) == sorted([("2,short",), ("3,c,many",), ("4,d,5,6",)] * n)
    with pytest.raises(ValueError):
        sources.scan_csv(spark, path, schema, strict=True, mark_bad=True)


def test_strict_csv_wants_the_headers_of_the_schema(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,other\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform|FAILED_READ_FILE"):
        sources.scan_csv(spark, str(tmp_path / "c.csv"), "id int, n int", strict=True).collect()
