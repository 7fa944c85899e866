import pytest
from pyspark.sql import functions as F

from starforge import sources
from starforge.operators import constraints, sketches
from starforge.operators.aggregates import unique_check
from starforge.operators.quality import DataQualityError
from starforge.plans import dictionary, publish
from starforge.plans.publish import STAR_RULES, audit, load_audited_star, no_orphans, publish_views, published_folder
from starforge.workload import raw
from starforge.workload.registry import Tables

DATA = "/root/testdata/sf0.001"


def drop(spark, *names):
    for name in names:
        spark.sql(f"DROP VIEW IF EXISTS {name}")


def test_views_are_swapped_together_or_not_at_all(spark, tmp_path):
    drop(spark, "pub_a", "pub_b")
    folders = {v: sources.write_parquet(spark.range(n), str(tmp_path / v)) for v, n in (("a1", 1), ("b1", 2), ("a2", 3))}
    publish_views(spark, {"pub_a": folders["a1"], "pub_b": folders["b1"]})
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        publish_views(spark, {"pub_a": folders["a2"], "pub_b": str(tmp_path / "gone"), "pub_c": folders["b1"]})
    assert (spark.table("pub_a").count(), spark.table("pub_b").count()) == (1, 2)
    assert published_folder(spark, "pub_a") == folders["a1"] and published_folder(spark, "pub_c") is None
    publish_views(spark, {"pub_a": folders["a2"]})
    assert spark.table("pub_a").count() == 3
    drop(spark, "pub_a", "pub_b")


def test_audit_lists_every_failed_rule(spark):
    tables = {"f": spark.createDataFrame([(1,), (2,), (None,)], "k int"), "d": spark.createDataFrame([(1,)], "k int")}
    empty = {**tables, "f": tables["f"].where("k = 1")}
    assert audit(empty, [no_orphans("f", "d", "k")]).first()["status"] == "OK"
    with pytest.raises(DataQualityError) as error:
        audit(tables, [no_orphans("f", "d", "k"), no_orphans("d", "f", "k")])
    assert [(r["table_name"], r["entries"]) for r in error.value.failures] == [("f.k", 1)]


def test_readers_see_the_last_good_load(spark, tmp_path, monkeypatch):
    t = Tables(spark, DATA)
    events = raw.event_log(t).where("userId < 20").cache()
    songs = raw.catalogue(t)
    root, names = str(tmp_path / "star"), ["f_songplays", "d_users", "d_songs", "d_artists", "d_time"]
    drop(spark, *[f"aud_{n}" for n in names])
    report = load_audited_star(events, songs, root, "one", "aud_", STAR_RULES)
    assert {r["status"] for r in report.collect()} == {"OK"} and report.count() == 8
    seen = lambda: {n: (spark.table(f"aud_{n}").count(), published_folder(spark, f"aud_{n}")) for n in names}
    first = seen()
    with pytest.raises(DataQualityError):
        load_audited_star(events.withColumn("level", F.lit("")), songs, root, "two", "aud_", STAR_RULES)
    # A load that dies while it is built is not seen either, and its name can be used again.
    load = publish.staged_load.load_songplay_star

    def dies(*args, **kwargs):
        load(*args, **kwargs)
        raise OSError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(publish.staged_load, "load_songplay_star", dies)
        with pytest.raises(OSError):
            load_audited_star(events, songs, root, "three", "aud_")
    assert seen() == first
    load_audited_star(events.where("userId < 10"), songs, root, "three", "aud_", STAR_RULES)
    after = seen()
    assert after["d_users"][0] < first["d_users"][0] and all(p.endswith(f"/three/{n}") for n, (_, p) in after.items())
    with pytest.raises(ValueError):
        load_audited_star(events, songs, root, "three", "aud_")
    events.unpersist()
    drop(spark, *[f"aud_{n}" for n in names])


def test_sketches_of_parts_give_the_total(spark, tmp_path):
    path = str(tmp_path / "sketches")
    frame = lambda a, b: spark.range(a, b).select(
        "id", (F.col("id") % 5000).alias("few"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("half")
    )
    # Parts overlap: values that are in both count once.
    for n, part in enumerate((frame(0, 30_000), frame(20_000, 60_000))):
        kept = sketches.distinct_sketches(part, ["id", "few", "half"]).withColumn("load", F.lit(n))
        kept.write.mode("append").parquet(path)
    got = {r["column_name"]: r for r in sketches.unique_candidates(spark.read.parquet(path)).collect()}
    exact = {"id": (70_000, 60_000), "few": (70_000, 5000), "half": (35_000, 30_000)}
    for column, (entries, distinct) in exact.items():
        assert got[column]["entries"] == entries
        assert abs(got[column]["distinct_estimate"] - distinct) <= sketches.error_bound() * distinct
        assert not got[column]["may_be_unique"]
    once = sketches.unique_candidates(sketches.distinct_sketches(frame(0, 40_000), ["id", "few"]))
    assert {r["column_name"]: r["may_be_unique"] for r in once.collect()} == {"id": True, "few": False}
    assert unique_check(frame(0, 40_000), "id").first()["is_unique"]


def test_more_registers_give_a_smaller_bound(spark):
    assert sketches.error_bound(10) > sketches.error_bound(14) and sketches.error_bound(14) < 0.025
    empty = sketches.distinct_sketches(spark.range(0), ["id"], lg_k=10)
    assert sketches.unique_candidates(empty, 10).first()["entries"] == 0


def test_dictionary_of_the_catalogue_alone(spark, tmp_path):
    sources.drop_table(spark, "dict_people")
    rows = sources.described(spark.createDataFrame([(1, "a"), (2, None)], "id int, name string"), {"name": "it's a name"})
    sources.ensure_table(spark, "dict_people", rows.schema, str(tmp_path / "p"), primary_key=["id"], comment="all people")
    constraints.load_table(rows, "dict_people", "append_only")
    got = [tuple(r) for r in dictionary.catalogue_dictionary(spark, {"people": "dict_people"}, with_entries=True).collect()]
    assert got == [
        ("people", "all people", 1, "id", "not set", "int", False, 2, 2),
        ("people", "all people", 2, "name", "it's a name", "string", True, 2, 1),
    ]
    sources.drop_table(spark, "dict_people")


def test_saved_tables_keep_comments(spark, tmp_path):
    rows = sources.described(spark.range(3), {"id": "a number"})
    saved = sources.save_table(rows, "dict_numbers", path=str(tmp_path / "n"))
    assert saved.schema["id"].metadata["comment"] == "a number"
    assert spark.catalog.listColumns("dict_numbers")[0].description == "a number"
    sources.drop_table(spark, "dict_numbers")
