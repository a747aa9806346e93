import datetime

from pyspark.sql import functions as F

from footfall.functions import (
    lenient_double, lenient_int, normalize_json_list, normalize_json_map, null_if_placeholder,
    parse_day, parse_totals,
)


def apply(spark, function, inputs, dtype="string"):
    df = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {dtype}")
    return [row[1] for row in df.select("i", function(F.col("x"))).orderBy("i").collect()]


def test_placeholder_wipes_the_whole_value(spark):
    texts = ["not available in demo dataset", "a not available in demo dataset b",
             "x Not available in demo dataset", "", None]
    assert apply(spark, null_if_placeholder, texts) == [None, None, texts[2], "", None]


def test_lenient_int_equals_a_cast_without_ansi(spark):
    texts = ["1", "-1", "+7", " 12 ", "2.5", "-3.9", ".5", ".", "+", "", "x", "1e3", "007",
             "99999999999", "99999999999.5", "2147483647", "-2147483648", "2147483648", "2.",
             "1 2", "\t3\n", None, "-.5", "2.x", "٣", "1.2.3", "--1", "- 1", "1\x00"]
    got = apply(spark, lenient_int, texts)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = apply(spark, lambda x: x.cast("int"), texts)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert got == want
    assert got[4:7] == [2, -3, 0]


def test_lenient_double(spark):
    assert apply(spark, lenient_double, ["1e3", "x", "", None, " 2.5 "]) == [
        1000.0, None, None, None, 2.5]


def test_parse_day(spark):
    texts = ["20170101", "bad", "20170230", "2017-01-01", " 20170101", None]
    assert apply(spark, parse_day, texts) == [datetime.date(2017, 1, 1)] + [None] * 5
    assert apply(spark, parse_day, [20240229], "int") == [datetime.date(2024, 2, 29)]


def test_json_map(spark):
    texts = ['{"a":1,"b":{"c":2}}', '{ "a" : "x" }', "not json", '[{"a":1}]', "", None]
    assert apply(spark, normalize_json_map, texts) == [
        '{"a":"1","b":"{\\"c\\":2}"}', '{"a":"x"}', None, None, None, None]


def test_json_list(spark):
    texts = ["[]", '[{"index": 4, "value": "x"}]', '{"index":"4"}', "bad", None]
    assert apply(spark, normalize_json_list, texts) == [
        "[]", '[{"index":"4","value":"x"}]', None, None, None]


def test_totals_keep_the_row_when_malformed(spark):
    texts = ['{"visits":1,"other":2}', '{"VISITS":"1"}', "bad", None]
    got = apply(spark, parse_totals, texts)
    assert [row and row["visits"] for row in got] == ["1", None, None, None]
    assert got[2] is not None
