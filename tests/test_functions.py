import datetime as dt

import pytest
from pyspark.sql import functions as F

from starforge.functions import dates, predicates, register_functions, text


def one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


def test_epoch_ms_keeps_minutes_and_milliseconds(spark):
    ms = 1541105830796
    assert one(spark, dates.epoch_ms_to_ts("v"), ms, "long") == dt.datetime(2018, 11, 1, 20, 57, 10, 796000)
    assert one(spark, dates.epoch_ms_to_ts("v", "second"), ms, "long") == dt.datetime(2018, 11, 1, 20, 57, 10)
    with pytest.raises(ValueError):
        dates.epoch_ms_to_ts("v", "minute")


@pytest.mark.parametrize(
    "days, expected",
    [(0.0, dt.date(1900, 1, 1)), (-5.0, dt.date(1900, 1, 1)), (None, dt.date(1900, 1, 1)), (20454.0, dt.date(2016, 1, 1))],
)
def test_epoch_days(spark, days, expected):
    assert one(spark, dates.epoch_days_to_date("v"), days, "double") == expected


def test_epoch_days_as_sql_function(spark):
    assert "epoch_days_to_date" in register_functions(spark)
    row = spark.sql("SELECT epoch_days_to_date(20454.0D), epoch_days_to_date(NULL), is_blank('  ')").first()
    assert tuple(row) == (dt.date(2016, 1, 1), dt.date(1900, 1, 1), True)


def test_sunday_in_every_numbering(spark):
    sunday = dt.date(2018, 11, 4)
    numbers = {b: one(spark, dates.day_number("v", b), sunday, "date") for b in ("monday0", "sunday0", "sunday1")}
    assert numbers == {"monday0": 6, "sunday0": 0, "sunday1": 1}
    assert one(spark, dates.time_parts("v")["week"], sunday, "date") == 44
    with pytest.raises(ValueError):
        dates.day_number("v", "friday7")


def test_period_labels(spark):
    day = dt.date(2016, 3, 9)
    assert one(spark, dates.period_label("v", "quarter"), day, "date") == "2016/1"
    assert one(spark, dates.period_label("v", "month"), day, "date") == "2016/03"


def test_parse_date_gives_null_for_bad_text(spark):
    assert one(spark, dates.parse_date("v"), "20160131", "string") == dt.date(2016, 1, 31)
    assert one(spark, dates.parse_date("v"), "D/S", "string") is None


@pytest.mark.parametrize("value, kind, blank", [("", "string", True), (" ", "string", True), (None, "string", True),
                                               (0, "int", False), (None, "int", True), ("x", "string", False)])
def test_is_blank(spark, value, kind, blank):
    assert one(spark, predicates.is_blank("v"), value, kind) is blank


@pytest.mark.parametrize(
    "departure, expected, verdict",
    [
        (dt.date(2015, 12, 31), dt.date(1900, 1, 1), "too_early"),
        (dt.date(2017, 6, 15), dt.date(1900, 1, 1), "too_late"),
        (dt.date(2016, 2, 1), dt.date(1900, 1, 1), "before_other"),
        (dt.date(2016, 4, 1), dt.date(2016, 4, 1), "ok"),
        (None, None, "missing"),
    ],
)
def test_clean_and_classify_dates(spark, departure, expected, verdict):
    df = spark.createDataFrame([(dt.date(2016, 3, 1), departure)], "arr date, dep date")
    rules = dict(lo="2016-01-01", hi="2017-06-14", not_before="arr")
    got = df.select(predicates.clean_date("dep", **rules), predicates.date_class("dep", **rules)).first()
    assert tuple(got) == (expected, verdict)


def test_lenient_int(spark):
    assert one(spark, text.lenient_int("v"), "", "string") is None
    assert one(spark, text.lenient_int("v"), "236", "string") == 236


def test_hash_id_separates_fields_and_takes_nulls(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc")], "x string, y string")
    ids = [r[0] for r in df.select(text.hash_id("x", "y")).collect()]
    assert len(set(ids)) == 3 and all(len(i) == 32 for i in ids)
    odd = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("", "c"), (None, "c"), ("-", "c")], "x string, y string")
    assert odd.select(text.hash_id("x", "y")).distinct().count() == 5


def test_hash_id_is_the_same_in_every_zone(spark):
    df = spark.createDataFrame([(1_700_000_000_123_456,)], "us long").select(F.timestamp_micros("us").alias("ts"))
    seen = set()
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seen.add(df.select(text.hash_id(F.unix_micros("ts"))).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(seen) == 1
    with pytest.raises(Exception, match="unix_micros"):
        df.select(text.hash_id("ts")).collect()


def test_extract_drops_or_keeps_unmatched(spark, rows):
    df = spark.createDataFrame([("   236 =  'AFGHANISTAN'",), ("/* comment */",)], "value string")
    spec = {"code": (1, "int"), "name": (2, "string")}
    pattern = r"^\s*(\d+)\s*=\s+'(.*)'"
    assert rows(text.extract_columns(df, "value", pattern, spec)) == [(236, "AFGHANISTAN")]
    assert text.unmatched(df, "value", pattern).count() == 1
    assert rows(text.extract_columns(df, "value", pattern, spec, keep_unmatched=True)) == [
        (236, "AFGHANISTAN"), (None, ""),
    ]


def test_rewrite_applies_rules_in_order(spark, rows):
    df = spark.createDataFrame([("abc", "k")], "a string, b string")
    out = text.rewrite(df, [("a", "b", "xx"), ("a", "xx", "y"), ("b", "k", "K")])
    assert rows(out) == [("ayc", "K")]


def test_repair_touches_only_matching_rows(spark, rows):
    df = spark.createDataFrame([("DOVER-AFB", "DE"), ("WILMINGTON", "DE")], "name string, state string")
    fixed = text.repair(df, [text.Repair("name", "^DOVER-AFB", {"name": "bad", "state": "none"})])
    assert rows(fixed) == [("WILMINGTON", "DE"), ("bad", "none")]


def test_drop_matching_keeps_nulls(spark, rows):
    df = spark.createDataFrame([("INVALID: X",), ("SPAIN",), (None,)], "name string")
    assert rows(text.drop_matching(df, "name", ["^INVALID", "^No "])) == [("SPAIN",), (None,)]


def test_row_json_and_full_name(spark):
    df = spark.createDataFrame([("Ann", "Lee")], "f string, l string")
    assert df.select(text.row_json("f", "l")).first()[0] == '{"f":"Ann","l":"Lee"}'
    assert df.select(text.full_name("f", F.col("l"))).first()[0] == "Ann Lee"
