import datetime as dt

import pytest
from pyspark.sql import functions as F

from starforge.operators import aggregates, calendar, projection, quality


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "a", 1.0), (3, None, None), (4, " ", 3.0)], "id int, k string, v double")


def test_profiles_count_rows_with_nulls(df, spark, rows):
    assert rows(aggregates.dup_profile(df, ["k", "v"])) == [(4, 3, 1)]
    assert rows(aggregates.dup_profile(df.limit(0))) == [(0, 0, 0)]
    assert rows(aggregates.unique_check(df, "k")) == [("k", 3, 2, False)]
    assert rows(aggregates.null_counts(df)) == [("id", 0), ("k", 1), ("v", 1)]
    assert rows(aggregates.non_null_counts(df)) == [("id", 4), ("k", 3), ("v", 3)]
    assert rows(aggregates.missing_ratio(df)) == [("id", 0.0), ("k", 0.25), ("v", 0.25)]
    assert rows(aggregates.distinct_except(df, ["id"]), "id") == [(1,), (3,), (4,)]
    assert rows(aggregates.describe(df), "column_name", "entries", "mean") == [("id", 4, 2.5), ("v", 3, 1.6667)]
    assert rows(aggregates.value_frequencies(df, "k")) == [(" ", 1), ("a", 2), (None, 1)]


def test_group_profile_truncates(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.82)], "k string, v double")
    assert rows(aggregates.group_profile(df, ["k"], {"r": ("v", 1)}, {"w": "v"})) == [("a", 1.9, 1)]


def test_bounds_with_and_without_sentinel(spark, rows):
    days = [dt.date(1900, 1, 1), dt.date(2016, 1, 2), dt.date(2016, 1, 5)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert rows(aggregates.bounds(df, "d", ignore="1900-01-01")) == [(days[1], days[2])]
    clean = df.where(F.col("d") > "1900-01-01")
    assert rows(aggregates.bounds(clean, "d", ignore="1900-01-01")) == [(days[1], days[2])]
    assert rows(aggregates.bounds(df, "d")) == [(days[0], days[2])]


def test_date_series_across_dst_in_any_time_zone(spark, rows):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = calendar.date_series(spark, dt.date(2018, 10, 27), dt.date(2018, 10, 30))
        assert rows(got) == [(dt.date(2018, 10, d),) for d in (27, 28, 29, 30)]
        ends = spark.createDataFrame([(dt.date(2018, 3, 24),), (dt.date(2018, 3, 27),)], "d date")
        assert rows(calendar.date_series_of(ends, "d")) == [(dt.date(2018, 3, d),) for d in (24, 25, 26, 27)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert calendar.date_series(spark, dt.date(2018, 1, 1), dt.date(2018, 1, 9), step=4).count() == 3


def test_date_dimension_with_default_member(spark, rows):
    df = spark.createDataFrame([(dt.date(1900, 1, 1),), (dt.date(2018, 11, 3),), (dt.date(2018, 11, 4),)], "d date")
    dim = calendar.build_date_dimension(df, "d", "d_dd_", default="1900-01-01")
    assert len(dim.columns) == 12 and dim.count() == 3
    sunday = dim.where("d_dd_id = '2018-11-04'").first()
    assert (sunday.d_dd_year_quarter, sunday.d_dd_year_month, sunday.d_dd_week, sunday.d_dd_dayofweek) == ("2018/4", "2018/11", 44, 1)
    assert (sunday.d_dd_weekday, sunday.d_dd_weekday_short) == ("Sunday", "Sun")
    assert calendar.build_date_dimension(df.limit(0), "d", "x_").count() == 0


def test_blank_check_and_report(df, rows):
    assert rows(quality.check_not_blank(df, ["id", "k"], "t")) == [("t", 2, 4, "NOK")]
    report = quality.dq_report({"full": (df, ["id"]), "empty": (df.limit(0), ["id"])})
    assert rows(report) == [("empty", 0, 0, "NOK"), ("full", 0, 4, "OK")]
    assert quality.check_not_empty(df) and not quality.check_not_empty(df.limit(0))


def test_expectations(df, spark, rows):
    df.createOrReplaceTempView("checked")
    good = ("rows", "select count(*) from checked", 4)
    bad = ("nulls", "select count(1) from checked where k is null", 0)
    assert rows(quality.expect_sql(spark, [good]), "check_name", "status") == [("rows", "OK")]
    with pytest.raises(quality.DataQualityError) as error:
        quality.expect_sql(spark, [good, bad])
    assert [f["check_name"] for f in error.value.failures] == ["nulls"]
    assert rows(quality.expect_sql(spark, [bad], strict=False), "actual", "status") == [("1", "NOK")]


def test_domain_orphans_coverage(df, spark, rows):
    assert rows(quality.check_domain(df, "k", ["a"])) == [(" ", 1)]
    dim = spark.createDataFrame([("a",)], "code string")
    assert rows(quality.orphans(df, dim, "k", "code")) == [(" ",)]
    lines = spark.createDataFrame([("A, AK",), ("B AK",), ("??",)], "value string")
    patterns = {"strict": r"^\w, \w+$", "lenient": r"^\w,? \w+$"}
    assert rows(quality.coverage(lines, "value", patterns)) == [(3, 1, 2)]
    assert rows(quality.uncovered(lines, "value", *patterns.values())) == [("B AK",)]


def test_projection_helpers(df, spark, rows):
    assert projection.restage(df, "i", "d_").columns == ["d_d", "k", "v"]
    assert projection.rename(df, {"k": "key"}).columns == ["id", "key", "v"]
    assert projection.except_cols(df, "v").columns == ["id", "k"]
    assert rows(projection.with_key(df, "pk", "id"), "pk") == [(1,), (2,), (3,), (4,)]
    assert rows(projection.drop_empty(df, "k"), "id") == [(1,), (2,)]
    assert rows(projection.lookup(df, k="a", id=2), "v") == [(1.0,)]
    assert rows(projection.fill_defaults(df, {"k": "NA", "v": 0.0}).where("id = 3")) == [(3, "NA", 0.0)]
    assert rows(projection.mismatches(spark.createDataFrame([(1, 1), (1, 2)], "a int, b int"), "a", "b")) == [(1, 2)]
    assert rows(projection.default_member(df, {"id": 99, "k": "none"}).where("id = 99")) == [(99, "none", None)]


def test_clustered_keeps_a_hot_key_ordered_over_tasks(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("o")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps partitions this small apart
    try:
        out = projection.clustered(df, ["k"], ["o"]).withColumn("p", F.spark_partition_id())
        hot = [(r.p, r.o) for r in out.where("k = 1").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert hot == sorted(hot) and len({p for p, _ in hot}) > 1
