import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.errors import AnalysisException

from footfall.plans import clean_raw, ingest_csv
from footfall.sources import read_csv, read_csv_wide, read_parquet, write_csv


def test_clean_raw_order_matters(raw):
    df = clean_raw(raw(
        {"device": '{ "a": 1 }', "customDimensions": '[{"i": 1}]'},
        {"device": '{"a": "not available in demo dataset"}'},
        {"device": "bad", "geoNetwork": "x not available in demo dataset"},
    ))
    rows = df.collect()
    assert (rows[0]["device"], rows[0]["customDimensions"]) == ('{"a":"1"}', '[{"i":"1"}]')
    assert rows[1]["device"] is None and rows[2]["device"] is None
    assert rows[2]["geoNetwork"] is None and rows[2]["fullVisitorId"] == "u1"
    assert df.columns == raw({}).columns


def test_clean_raw_leaves_other_types(raw):
    from pyspark.sql import functions as F
    df = clean_raw(raw({}).withColumn("n", F.lit(1)))
    assert dict(df.dtypes)["n"] == "int"


def test_clean_raw_needs_its_columns(raw):
    with pytest.raises(AnalysisException, match="device"):
        clean_raw(raw({}).drop("device"))


def test_csv_dialect(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        'a,b,c\n1,"two\nlines","say ""hi"""\n2,short\n3,x,y,too long\n"",,"not, split"\n')
    df = read_csv(spark, str(tmp_path / "in.csv"))
    assert df.dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    assert [tuple(row) for row in df.collect()] == [
        ("1", "two\nlines", 'say "hi"'), ("2", "short", None), ("3", "x", "y"),
        (None, None, "not, split")]


def test_csv_round_trip_keeps_odd_texts(spark, tmp_path):
    texts = ['a "quoted" one', "line\nbreak", "  outer blanks  ", "comma, semi;", "back\\slash",
             "ends with \\", "tab\t", "é漢", "\r\nwindows", '"', "'", "#x", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    write_csv(df, f"{tmp_path}/csv")
    back = {int(row["i"]): row["t"] for row in read_csv(spark, f"{tmp_path}/csv").collect()}
    assert [back[i] for i in range(len(texts))] == texts


def test_wide_csv_takes_huge_fields(spark, tmp_path):
    huge = "x" * 10_000_100
    write_csv(spark.createDataFrame([(huge,)], "t string"), f"{tmp_path}/csv")
    for reader in (read_csv, read_csv_wide):
        assert reader(spark, f"{tmp_path}/csv").first()["t"] == huge
    with pytest.raises((Py4JJavaError, PySparkException)):
        read_csv_wide(spark, f"{tmp_path}/csv", max_chars=1000).first()


@pytest.mark.parametrize("partitions, files", [(None, 1), (4, 4)])
def test_ingest(spark, raw, tmp_path, partitions, files):
    rows = [{"visitId": str(i), "hits": "[{'a':\n'b'}]"} for i in range(100)]
    write_csv(raw(*rows).coalesce(1), f"{tmp_path}/csv")
    ingest_csv(spark, f"{tmp_path}/csv", f"{tmp_path}/out", partitions=partitions)
    out = read_parquet(spark, f"{tmp_path}/out")
    assert len(out.inputFiles()) == files
    assert sorted(out.collect()) == sorted(clean_raw(raw(*rows)).collect())
