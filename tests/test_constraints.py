from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starforge import sources
from starforge.operators import constraints
from starforge.operators.constraints import load_constrained, load_table
from starforge.operators.load import replace_partitions

BROKEN = "is broken by"


def people(spark, *data):
    return spark.createDataFrame(list(data), "id int, name string, place string")


def files(path):
    return sorted(str(f) for f in Path(path).rglob("*.parquet"))


@pytest.mark.parametrize("mode", ["append_only", "truncate_load"])
def test_a_load_that_breaks_a_constraint_leaves_the_target_as_it_was(spark, tmp_path, rows, mode):
    target = str(tmp_path / "t")
    load_constrained(people(spark, (1, "a", "x"), (2, "b", None)), target, "append_only", ["name"], ["id"])
    before = files(target)
    for bad in ((3, None, "x"), (None, "c", "x"), (4, "c", "x")):
        batch = people(spark, (4, "d", "y"), bad).repartition(2)
        with pytest.raises(Exception, match=BROKEN):
            load_constrained(batch, target, mode, ["name"], ["id"])
        assert files(target) == before
    assert rows(spark.read.parquet(target)) == [(1, "a", "x"), (2, "b", None)]


def test_append_compares_with_known_keys_and_replacement_does_not(spark, tmp_path, rows):
    target = str(tmp_path / "t")
    load_constrained(people(spark, (1, "a", "x")), target, "append_only", primary_key=["id", "place"])
    load_constrained(people(spark, (1, "b", "y")), target, "append_only", primary_key=["id", "place"])
    with pytest.raises(Exception, match=r"PRIMARY KEY \(id, place\)"):
        load_constrained(people(spark, (1, "c", "y")), target, "append_only", primary_key=["id", "place"])
    load_constrained(people(spark, (1, "c", "y")), target, "truncate_load", primary_key=["id", "place"])
    assert rows(spark.read.parquet(target)) == [(1, "c", "y")]
    assert not Path(f"{target}.incoming").exists() and not Path(f"{target}.replaced").exists()


def test_a_failed_swap_puts_the_old_folder_back(spark, tmp_path, rows):
    target = str(tmp_path / "t")
    sources.write_parquet(people(spark, (1, "a", "x")), target)
    with pytest.raises(OSError):
        constraints.replace_folder(spark, str(tmp_path / "missing"), target)
    assert rows(spark.read.parquet(target)) == [(1, "a", "x")]


def test_checks_shuffle_rows_once_by_the_key(spark, plan):
    text = plan(constraints.constrained(people(spark), ["name"], ["id"]))
    assert text.count("Exchange") == 1 and "hashpartitioning(id" in text
    assert "Exchange" not in plan(constraints.constrained(people(spark), ["name"]))


def test_catalogue_table_keeps_constraints_comments_and_layout(spark, tmp_path, rows):
    schema = sources.described(people(spark), {"name": "the person's name"}).schema
    sources.drop_table(spark, "people")
    sources.ensure_table(
        spark, "people", schema, str(tmp_path / "people"), layout=sources.Layout(("id",), 4, ("id",)),
        primary_key=["id"], comment="all people",
    )
    assert sources.table_constraints(spark, "people") == (["id"], ["id"])
    assert {c.name: c.description for c in spark.catalog.listColumns("people")}["name"] == "the person's name"
    load_table(people(spark, (1, "a", "x"), (2, None, "y")), "people", "append_only")
    for mode, bad in (("append_only", (2, "b", "z")), ("truncate_load", (None, "c", "z"))):
        with pytest.raises(Exception, match=BROKEN):
            load_table(people(spark, bad), "people", mode)
        assert rows(spark.table("people"), "id", "name", "place") == [(1, "a", "x"), (2, None, "y")]
    load_table(people(spark, (9, "n", "z")), "people", "truncate_load")
    assert rows(spark.table("people"), "id") == [(9,)]
    sources.drop_table(spark, "people")


def test_not_null_of_a_schema_is_kept(spark, tmp_path):
    sources.drop_table(spark, "strict")
    sources.ensure_table(spark, "strict", "a int NOT NULL, b int", str(tmp_path / "s"))
    assert sources.table_constraints(spark, "strict") == (["a"], [])
    sources.drop_table(spark, "strict")
    with pytest.raises(ValueError):
        sources.described(people(spark), {"nmae": "x"})


def test_replaced_partitions_only(spark, tmp_path, rows):
    target = str(tmp_path / "p")
    frame = lambda *data: spark.createDataFrame(list(data), "v int, m int")
    replace_partitions(frame((1, 1), (2, 2), (3, 3)), target, ["m"])
    untouched = {f for f in files(target) if "/m=2/" not in f}
    for _ in range(2):
        replace_partitions(frame((20, 2), (21, 2), (4, 4)), target, ["m"])
    assert untouched <= set(files(target))
    assert rows(spark.read.parquet(target)) == [(1, 1), (20, 2), (21, 2), (3, 3), (4, 4)]
    bad = frame((5, 1)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        replace_partitions(bad, target, ["m"])
    assert spark.read.parquet(target).count() == 5
    with pytest.raises(ValueError):
        replace_partitions(frame((1, 1)), target, [])
