from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from footfall.scratch import drop_database, new_database, new_folder, shared_root
from footfall.sources import (
    accumulate_parquet, export_table, read_accumulated, read_csv, read_csv_by_header, read_lot,
    read_parquet, read_table, write_csv, write_table,
)


def test_accumulate_replaces_then_appends(spark, tmp_path):
    path = f"{tmp_path}/out"
    for _ in range(2):
        batches = (spark.range(n).coalesce(1) for n in (2, 3, 4))
        assert accumulate_parquet(batches, path) == 3
        assert read_parquet(spark, path).count() == 9
    files = read_parquet(spark, path).inputFiles()
    assert sorted(read_parquet(spark, file).count() for file in files) == [2, 3, 4]


def test_read_accumulated_finds_sub_folders(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/out/lote-000001")
    spark.range(3).write.parquet(f"{tmp_path}/out/lote-000002")
    df = read_accumulated(spark, f"{tmp_path}/out")
    assert (df.count(), df.columns) == (5, ["id"])


def test_export_is_one_file_only_when_asked(spark, tmp_path):
    name = f"{new_database(spark, 'export')}.numbers"
    write_table(spark.range(10_000).repartition(4), name)
    export_table(spark, name, f"{tmp_path}/one", single_file=True)
    export_table(spark, name, f"{tmp_path}/many")
    one, many = read_parquet(spark, f"{tmp_path}/one"), read_parquet(spark, f"{tmp_path}/many")
    assert len(one.inputFiles()) == 1 and many.count() == 10_000  # test_star has many files
    assert one.exceptAll(many).count() == 0 and many.count() == 10_000


def test_lots_are_read_with_all_their_columns(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(f"{tmp_path}/lots/1")
    spark.createDataFrame([(2,)], "a int").write.parquet(f"{tmp_path}/lots/2")
    rows = read_lot(spark, f"{tmp_path}/lots", recursive=True).collect()
    assert sorted(map(tuple, rows)) == [(1, "x"), (2, None)]


def test_csv_files_are_matched_by_header(spark, tmp_path):
    spark.createDataFrame([("1", "2")], "a string, b string").write.csv(f"{tmp_path}/1", header=True)
    spark.createDataFrame([("20", "10")], "b string, a string").write.csv(f"{tmp_path}/2", header=True)
    rows = read_csv_by_header(spark, f"{tmp_path}/1", f"{tmp_path}/2").collect()
    assert sorted(map(tuple, rows)) == [("1", "2"), ("10", "20")]
    with pytest.raises((Py4JJavaError, PySparkException)):
        read_csv(spark, f"{tmp_path}/1", f"{tmp_path}/2").collect()


def test_one_column_of_nulls_survives_csv(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "t string")
    write_csv(df, f"{tmp_path}/csv")
    assert sorted(r.t or "" for r in read_csv(spark, f"{tmp_path}/csv").collect()) == ["", "", "a", "b"]


def test_databases_are_dropped(spark):
    name = new_database(spark, "short")
    assert spark.catalog.databaseExists(name)
    drop_database(spark, name)
    assert not spark.catalog.databaseExists(name)


def test_tables_are_replaced(spark):
    name = f"{new_database(spark, 'tables')}.t"
    write_table(spark.range(3), name)
    write_table(spark.createDataFrame([("a",)], "s string"), name)
    assert [tuple(row) for row in read_table(spark, name).collect()] == [("a",)]


def test_scratch_lies_in_the_shared_folder(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_a_cluster_needs_a_shared_folder():
    def session(master, setting=None, directory=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: setting),
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: directory))

    assert shared_root(session("spark://host", "hdfs:/a/")) == "hdfs:/a"
    assert shared_root(session("yarn", None, "hdfs:/b")) == "hdfs:/b"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session("yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session("local-cluster[3,2,1000]"))
