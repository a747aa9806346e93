import csv
import glob

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.operators import split_csv
from footfall.operators.chunks import running_total
from footfall.sources import write_csv
from footfall.sources.records import Run


def sizes(folder):
    """Rows and columns of every chunk file, read with no help from Spark."""
    found = {}
    for path in glob.glob(f"{folder}/parte=*/part-*"):
        with open(path, newline="", encoding="utf-8") as file:
            header, *rows = csv.reader(file)
        number = int(path.split("parte=")[1].split("/")[0])
        assert number not in found, "one file per chunk"
        found[number] = (header, rows)
    return [found[number] for number in sorted(found)]


def test_one_file(spark, tmp_path):
    with open(tmp_path / "in.csv", "w", encoding="utf-8") as file:
        file.write("id,text\n")
        file.writelines(f'{i},"line {i}\nsays ""hi"""\n' for i in range(2500))
    split_csv(spark, str(tmp_path / "in.csv"), f"{tmp_path}/out", 1000)
    parts = sizes(f"{tmp_path}/out")
    assert [len(rows) for _, rows in parts] == [1000, 1000, 500]
    assert all(header == ["id", "text"] for header, _ in parts)
    rows = [row for _, rows in parts for row in rows]
    assert rows == [[str(i), f'line {i}\nsays "hi"'] for i in range(2500)]


def test_many_files_with_a_hot_one(spark, tmp_path):
    ids = spark.range(3000).withColumn("file", F.when(F.col("id") < 2000, 0).otherwise(
        F.floor(F.col("id") / 100)))
    write_csv(ids.repartitionByRange(6, "file").sortWithinPartitions("id"), f"{tmp_path}/in")
    split_csv(spark, f"{tmp_path}/in", f"{tmp_path}/out", 700)
    parts = sizes(f"{tmp_path}/out")
    assert [len(rows) for _, rows in parts] == [700, 700, 700, 700, 200]
    assert [int(row[0]) for _, rows in parts for row in rows] == list(range(3000))


def test_no_rows_no_file(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,text\n")
    split_csv(spark, str(tmp_path / "in.csv"), f"{tmp_path}/out", 1000)
    assert sizes(f"{tmp_path}/out") == []


def test_ragged_rows_empty_lines_and_one_column_of_empties(spark, tmp_path):
    body = ['1,2,3', '', '4', '"a,""b""",x"y', 'it"s,"t', 'w,o",', '"",\r', 'last']
    (tmp_path / "in.csv").write_bytes("\n".join(["a,b", *body]).encode())
    split_csv(spark, str(tmp_path / "in.csv"), f"{tmp_path}/out", 3)
    texts = [b"".join(open(p, "rb").read() for p in sorted(glob.glob(f"{tmp_path}/out/parte={n}/part-*")))
             for n in range(3)]
    want = [body[:3], [body[3], body[4] + "\n" + body[5], body[6]], body[7:]]
    assert [t.decode() for t in texts] == ["\n".join(["a,b", *rows]) + "\n" for rows in want]

    (tmp_path / "one.csv").write_text('a\n\n""\nx\n\n')
    split_csv(spark, str(tmp_path / "one.csv"), f"{tmp_path}/one", 10)
    assert open(glob.glob(f"{tmp_path}/one/parte=0/part-*")[0]).read() == 'a\n\n""\nx\n\n'


def test_one_huge_quoted_file_is_read_by_many_tasks(spark, tmp_path):
    with open(tmp_path / "in.csv", "w", encoding="utf-8") as file:
        file.write("id,text\n")
        for i in range(3000):
            lines = "".join(f"{i} says ""hello"", line {k}\n" for k in range(i % 9))
            file.write(f'{i},"{lines}\n,"" ,"\n' if i % 4 else f"{i},plain\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(str(tmp_path / "in.csv")).rdd.getNumPartitions() > 5
        split_csv(spark, str(tmp_path / "in.csv"), f"{tmp_path}/out", 700)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    parts = sizes(f"{tmp_path}/out")
    assert [len(rows) for _, rows in parts] == [700, 700, 700, 700, 200]
    assert [int(row[0]) for _, rows in parts for row in rows] == list(range(3000))


def test_files_must_have_one_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "in" / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ValueError, match="headers"):
        split_csv(spark, f"{tmp_path}/in", f"{tmp_path}/out", 10)


def test_headers_of_many_lines_and_one_that_a_split_cuts(spark, tmp_path):
    (tmp_path / "in.csv").write_text('a,"b\nc ""x"""\n1,2\n3,4\n')
    split_csv(spark, str(tmp_path / "in.csv"), f"{tmp_path}/out", 1)
    assert sizes(f"{tmp_path}/out") == [(["a", 'b\nc "x"'], [["1", "2"]]), (["a", 'b\nc "x"'], [["3", "4"]])]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        with pytest.raises(ValueError, match="first split"):
            split_csv(spark, str(tmp_path / "in.csv"), f"{tmp_path}/out", 1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='a,"', max_size=12), st.booleans())
def test_ends_quoted_as_the_csv_module_reads(line, quoted):
    text = '"x\n' + line if quoted else line
    try:
        rows = list(csv.reader([*(t + "\n" for t in text.split("\n")), "z\n"]))
    except csv.Error:
        return
    # an open quote swallows the next line
    run = Run()
    run.begins(pa.array([line]))
    assert run.quoted[quoted] == (len(rows) == 1)


def test_running_total(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    rows = running_total(df, "k", "v", "before").orderBy("k").collect()
    total = 0
    for row in rows:
        assert row.before == total
        total += row.v
