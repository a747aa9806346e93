import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from footfall.operators import (
    column_profile, drop_columns, drop_rows_missing, keep_columns, map_string_columns,
    nullify_placeholders, require_columns, row_count, rows_where_null, table_counts, union_lots,
)


def test_drop_and_keep_ignore_missing_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, C int")
    assert drop_columns(df, ["b", "nope"]).columns == ["a", "C"]
    assert keep_columns(df, ["C", "nope", "a", "B", "c"]).columns == ["C", "a"]


def test_columns_with_dots(spark):
    df = spark.createDataFrame([("x", 1)], "`a.b` string, `c` int")
    assert nullify_placeholders(keep_columns(df, ["a.b"])).columns == ["a.b"]
    assert column_profile(df).count() == 2


def test_required_columns(spark):
    with pytest.raises(AnalysisException, match="hits"):
        require_columns(spark.range(1), ["id", "hits"])


def test_string_columns_only(spark):
    df = spark.createDataFrame([("a", 1, ["a"])], "s string, i int, l array<string>")
    changed = map_string_columns(df, F.upper)
    assert changed.schema.simpleString() == df.schema.simpleString()
    assert changed.first() == ("A", 1, ["a"])


def test_rows_missing_a_key(spark):
    df = spark.createDataFrame(
        [("a", "b", 1.0), (None, "b", 1.0), ("a", None, 1.0), ("", "", 1.0),
         ("a", "b", float("nan")), ("a", "b", None)], "k string, l string, d double")
    for keys in (["k", "l"], ["k", "l", "d"]):
        kept, wanted = drop_rows_missing(df, keys), df.dropna(subset=keys)
        assert repr(kept.collect()) == repr(wanted.collect())


def test_key_filter_reaches_the_scan(spark, tmp_path, capsys):
    spark.createDataFrame([("a", "b")], "k string, l string").write.parquet(f"{tmp_path}/t")
    drop_rows_missing(spark.read.parquet(f"{tmp_path}/t"), ["k", "l"]).explain()
    assert "PushedFilters: [IsNotNull(k), IsNotNull(l)]" in capsys.readouterr().out


def test_union_is_by_name(spark):
    first = spark.createDataFrame([(1, "x")], "a int, b string")
    second = spark.createDataFrame([("y", 2.5)], "b string, a double")
    both = union_lots(first, second, first)
    assert both.dtypes == [("a", "double"), ("b", "string")]
    assert sorted(map(tuple, both.collect())) == [(1.0, "x"), (1.0, "x"), (2.5, "y")]
    with pytest.raises(AnalysisException):
        union_lots(first, spark.range(1)).collect()


def test_profile(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("c", 1)], "n string, n_0 int")
    profile = {row["column_name"]: (row["rows"], row["nulls"])
               for row in column_profile(df).collect()}
    assert profile == {"n": (3, 1), "n_0": (3, 2)}
    assert rows_where_null(df, "n").count() == 1
    assert row_count(df).first()["rows"] == 3
    counts = table_counts({"all": df, "none": df.limit(0)})
    assert dict(map(tuple, counts.collect())) == {"all": 3, "none": 0}
