"""Cut CSV files into numbered files of exactly N rows each, in input order, text unchanged."""

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.scratch import write_aside
from footfall.sources.records import SPLIT, runs, split_index, split_lines

# Tasks carry the code they run, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_ROWS_PER_FILE = 100_000

_LINES = "file string, start long, length long, seq long, value string, n_out long, n_in long"


def _lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line with its place in the split and the records begun so far, in both cases."""
    for _, run, piece, seq in runs(batches):
        n_out, n_in = run.add(piece["value"])
        yield pa.RecordBatch.from_arrays(
            [*(piece[name] for name in SPLIT), pa.array(np.arange(seq, seq + piece.num_rows)),
             piece["value"], pa.array(n_out), pa.array(n_in)],
            [field.split()[0] for field in _LINES.split(", ")])


def running_total(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows that come before in ``order`` (unique).

    Rows are dealt by range, each range adds up its own, and only one row per range, so no more
    than there are shuffle partitions, is added up in one place.
    """
    ranges = write_aside(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()),
                         "ranges")
    starts = (
        ranges.groupBy("_range").agg(F.sum(value).alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(
            Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("_range", "_base")
    )
    within = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return ranges.join(starts, "_range").withColumn(
        name, F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0))
    ).drop("_range", "_base")


def split_csv(
    spark: SparkSession,
    source: str,
    target: str,
    rows_per_file: int = DEFAULT_ROWS_PER_FILE,
    chunk_column: str = "parte",
) -> None:
    """Cut a CSV file (or folder) into CSV files of ``rows_per_file`` records with header.

    File number n goes to ``<target>/<chunk_column>=n/``; the last one may be short.  Records are
    copied as text, so ragged rows, empty lines and every field stay as they are.  Files count in
    name order and must have one header, else ``ValueError``, as where a header does not end within
    the first split of its file.

    A file is read in splits, also inside a quoted field of many lines.  One pass finds for each
    split how many records begin in it and whether a quoted field is open at its end, for both
    ways it may begin; these small rows, put together per file, tell how every split begins and
    which records it holds.  A second pass numbers the lines and one shuffle brings the lines of
    a chunk together.  Nothing is copied in between; should Spark cut the files differently in
    the second pass, it fails instead of losing a line.
    """
    lines = split_lines(spark, source)
    splits = split_index(lines)
    files = splits.groupBy("file").agg((F.max("records") - 1).alias("rows"))
    files = write_aside(running_total(files, "file", "rows", "offset"), "files")
    known = splits.join(files.select("file", "offset"), "file").drop("records", "header")

    record = F.col("before") + F.when(F.col("quoted") == 1, F.col("n_in")).otherwise(F.col("n_out")) - 1
    numbered = (
        lines.mapInArrow(_lines, _LINES).join(known, SPLIT, "left")
        .withColumn("record", F.when(F.col("before").isNull(), F.raise_error(
            F.lit("the files were cut differently in the second pass"))).otherwise(record))
    )
    headers = splits.where("start = 0").select("header").distinct().take(2)
    if any(row.header is None for row in headers):
        raise ValueError("the header of a file does not end in the file's first split")
    if len(headers) > 1:
        raise ValueError("the files have different headers")
    rows = files.agg(F.sum("rows")).first()[0] or 0
    header = F.lit(headers[0].header if headers else "")
    index = F.col("offset") + F.col("record") - 1
    body = numbered.where("record > 0").select(
        F.expr(f"(offset + record - 1) div {rows_per_file:d}").alias(chunk_column),
        index.alias("index"), "file", "start", "seq", "value")
    tops = spark.range(-(-rows // rows_per_file)).select(
        F.col("id").alias(chunk_column), F.lit(-1).cast("long").alias("index"),
        F.lit("").alias("file"), F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("seq"), header.alias("value"))
    (
        tops.unionByName(body).repartition(chunk_column)
        .sortWithinPartitions(chunk_column, "index", "file", "start", "seq")
        .select(chunk_column, "value")
        .write.mode("overwrite").partitionBy(chunk_column).text(target)
    )
