"""Parquet lots whose files may differ in columns."""

import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.scratch import write_aside

# Tasks carry the code they run, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAMED = 20


def escape_glob(path: str) -> str:
    """The path as Spark's readers take it literally."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path)


def read_lot(spark: SparkSession, *paths: str, recursive: bool = False) -> DataFrame:
    """Files or folders read as one: all rows, and every column that any file has.

    A column that a file lacks is NULL for its rows.  Spark reads all footers in parallel tasks;
    columns of one name whose types cannot be merged raise an error.
    """
    reader = spark.read.option("mergeSchema", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.parquet(*paths)


def parquet_files(spark: SparkSession, source: str) -> DataFrame:
    """``path, modified, length`` of the Parquet files of a folder, without their content."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(source)
    return listed.select("path", F.col("modificationTime").alias("modified"), "length")


_FOOTER = "path string, columns array<string>, error string, opened boolean"


def _columns(source) -> tuple[list[str] | None, str | None]:
    """The top-level columns of an open Parquet file, or why it is none."""
    try:
        return pq.read_schema(source).names, None
    except pa.ArrowInvalid as error:
        return None, str(error)


def _opened(path: str):
    """A file as Arrow opens it; what this fails with says nothing about the file's content."""
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def _footers_by_path(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path in batch["path"].to_pylist():
            try:
                file = _opened(path)
            except (OSError, pa.ArrowException):
                rows.append((path, None, None, False))
                continue
            with file:
                try:
                    rows.append((path, *_columns(file), True))
                except OSError:
                    rows.append((path, None, None, False))
        yield _footer_rows(rows)


def _footers_by_content(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path, content in zip(batch["path"], batch["content"], strict=True):
            rows.append((path.as_py(), *_columns(pa.BufferReader(content.as_buffer())), True))
        yield _footer_rows(rows)


def _footer_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.list_(pa.string()), pa.string(), pa.bool_())
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
        ["path", "columns", "error", "opened"])


def footers(files: DataFrame) -> DataFrame:
    """``path``, its top-level ``columns``, and the ``error`` of one that is no Parquet file.

    Tasks read the footers.  A file that they cannot open on their own, because of its store or of a
    short failure, is read whole by Spark, whose tasks are tried again; if that fails too the
    error is raised: a store that does not answer makes no file a bad one.  Written aside.
    """
    spark = files.sparkSession
    by_path = write_aside(files.select("path").mapInArrow(_footers_by_path, _FOOTER), "footers")
    closed = [escape_glob(row.path) for row in by_path.where("NOT opened").select("path").toLocalIterator()]
    found = by_path.where("opened")
    if closed:
        content = spark.read.format("binaryFile").load(closed).select("path", "content")
        again = content.mapInArrow(_footers_by_content, _FOOTER)
        found = found.unionByName(write_aside(again, "footers"))
    return found.select("path", "columns", "error")


def lacking(found: DataFrame, columns: list[str]) -> DataFrame:
    """``path`` and ``problem`` of the :func:`footers` that lack some of ``columns`` or are none."""
    wanted = F.array(*map(F.lit, columns))
    missing = F.array_except(wanted, "columns")
    problem = F.when(F.col("error").isNotNull(), F.concat(F.lit("is no Parquet file: "), "error")).when(
        F.size(missing) > 0, F.concat(F.lit("lacks "), F.array_join(missing, ", ")))
    return found.select("path", problem.alias("problem")).where("problem IS NOT NULL")


def files_lacking(spark: SparkSession, paths: list[str], columns: list[str]) -> dict[str, str]:
    """Of some files those that lack columns or are no Parquet files, with what is wrong."""
    if not paths:
        return {}
    files = spark.createDataFrame([(path,) for path in paths], "path string")
    even = files.repartition(min(len(paths), spark.sparkContext.defaultParallelism))
    return {row.path: row.problem for row in lacking(footers(even), columns).collect()}


def require_columns_in(found: DataFrame, columns: list[str]) -> None:
    """Raise ``ValueError`` naming :func:`footers` that lack a column; only some names are collected."""
    bad = lacking(found, columns)
    some = bad.orderBy("path").take(NAMED)
    if some:
        named = ", ".join(f"{row.path} {row.problem}" for row in some)
        raise ValueError(f"{bad.count()} files lack columns or cannot be read: {named}")
