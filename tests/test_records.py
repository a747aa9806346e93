import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.plans import ingest_csv
from footfall.sources import read_csv, read_csv_splits, read_parquet, write_csv
from footfall.sources.files import has_large_files
from footfall.sources.records import Run, csv_records, split_lines


def walk(lines, quoted):
    """Whether a record begins with each line, and how the last ends, byte by byte."""
    begins, state = [], "quoted" if quoted else "begin"
    for line in lines:
        begins.append(state != "quoted")
        for char in line + "\n":
            if state == "quoted":
                state = "closing" if char == '"' else "quoted"
            elif char in ",\n":
                state = "begin"
            elif char == '"' and state in ("begin", "closing"):
                state = "quoted"
            else:
                state = "plain"
    return begins, state == "quoted"


TEXTS = st.lists(st.lists(st.text(alphabet='ab,"\r', max_size=12), max_size=12), max_size=4)


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_functions_follow_both_cases_as_a_walk_does(batches):
    run = Run()
    walked = [walk([line for batch in batches for line in batch], quoted) for quoted in (False, True)]
    found = [[], []]
    for batch in batches:
        for case, begins in enumerate(run.begins(pa.array(batch, pa.string()))):
            found[case] += begins.tolist()
    assert found == [begins for begins, _ in walked]
    if any(batches):
        assert run.quoted == [quoted for _, quoted in walked]


def test_functions_over_a_slice_and_a_large_batch():
    rng = np.random.default_rng(1)
    lines = ["".join(rng.choice(list('ab,"'), 8)) for _ in range(20_000)]
    run = Run()
    begins = run.begins(pa.array(["x", *lines, "y"]).slice(1, len(lines)))
    for case in (0, 1):
        want, quoted = walk(lines, bool(case))
        assert begins[case].tolist() == want and run.quoted[case] == quoted


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_one_file_in_many_tasks(spark, tmp_path, small_splits):
    lines = ['id,text,"wide, name"']
    for i in range(400):
        lines.append([f"{i},plain {i},", f'{i},"two\r\nlines, ""{i}""",x', f'"{i}", blanks ,""', f"{i},short",
                      f'{i},"' + "long\n" * 60 + f'{i}",é', "", f'{i},a"b,c"d'][i % 7])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_bytes("\n".join(lines).encode())
    (tmp_path / "in" / "2.csv").write_bytes(b"\xef\xbb\xbf" + "\r\n".join(['id,text,"wide, name"', 'z,"q",1', "y,,"]).encode())
    (tmp_path / "in" / "3.csv").write_bytes(b'id,text,"wide, name"')
    source = f"{tmp_path}/in"
    assert split_lines(spark, source).rdd.getNumPartitions() > 8
    found, want = read_csv_splits(spark, source), read_csv(spark, source)
    assert found.columns == want.columns == ["id", "text", "wide, name"]
    assert rows_of(found) == rows_of(want) and found.count() == 400 - 57 + 2
    # whole records need no shuffle
    numbered = csv_records(spark, f"{source}/1.csv").select("record").collect()
    assert sorted(r.record for r in numbered) == list(range(len(lines)))


def test_line_breaks_in_quotes_stay_as_they_are(spark, tmp_path):
    (tmp_path / "1.csv").write_bytes(b'a,b\r\n1,"x\r\ny\nz"\r\n')
    assert rows_of(read_csv_splits(spark, str(tmp_path))) == [("1", "x\r\ny\nz")]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet='ab,"\n é', max_size=20), st.text(alphabet='ab,"\n', max_size=90)),
                min_size=1, max_size=40))
def test_equals_the_reader_of_whole_files(spark, tmp_path_factory, rows):
    path = tmp_path_factory.mktemp("csv") / "in.csv"
    quote = lambda text: '"' + text.replace('"', '""') + '"'
    path.write_text("a,b\n" + "".join(f"{quote(a)},{quote(b)}\n" for a, b in rows), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert rows_of(read_csv_splits(spark, str(path))) == rows_of(read_csv(spark, str(path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="names other columns"):
        read_csv_splits(spark, str(tmp_path)).collect()


def test_ingest_reads_large_files_in_splits(spark, raw, tmp_path):
    write_csv(raw({"visitId": "1"}, {"visitId": "2"}), f"{tmp_path}/in")
    assert not has_large_files(spark, f"{tmp_path}/in")
    ingest_csv(spark, f"{tmp_path}/in", f"{tmp_path}/whole")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50")
    try:
        assert has_large_files(spark, f"{tmp_path}/in")
        ingest_csv(spark, f"{tmp_path}/in", f"{tmp_path}/split")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    one, two = (read_parquet(spark, f"{tmp_path}/{name}") for name in ("whole", "split"))
    assert rows_of(one) == rows_of(two) and one.count() == 2
