"""CSV and Parquet files."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.sources.lots import read_lot
from footfall.sources.manifest import committed_lots, read_committed
from footfall.sources.records import csv_records

# Quoted fields may span lines; a quote inside one is doubled.  A folder stands for all
# files below it, and names of sub-folders (as ``split_csv`` makes) add no column.  A file
# whose header does not name the columns in the same order fails instead of being misread.
CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "recursiveFileLookup": True,
               "enforceSchema": False}

def read_csv(spark: SparkSession, *paths: str, schema: T.StructType | None = None,
             **options) -> DataFrame:
    """All columns as strings, named by the header (or by an all-string ``schema``).

    Fields may have any length.  Files read together must have the same header; read files
    with other orders of columns with :func:`read_csv_by_header`.  Each file is one task; read large
    ones with :func:`read_csv_splits`.
    """
    reader = spark.read.options(**CSV_OPTIONS).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(list(paths))


#: What of the options above is about a single record.
_RECORD_OPTIONS = {name: str(CSV_OPTIONS[name]).lower() for name in ("escape", "multiLine")}


def read_csv_splits(spark: SparkSession, *paths: str, schema: T.StructType | None = None,
                    **options) -> DataFrame:
    """As :func:`read_csv`, but a large file is read by many tasks, its quoted line breaks included.

    The text is read in splits, as many as Spark would make of a plain text file.  A pass over
    it, made at once, finds where records begin; then each task parses the records of its split
    (see :func:`footfall.sources.records.csv_records`).  That reads the text three times, so it pays
    for files of several splits.  Lines end with ``\n`` or ``\r\n``; inside quotes both stay (the
    other reader makes ``\n`` of both in files whose lines end with ``\r\n``).  Options for a
    single record (``sep`` and ``quote`` excepted) may be given.  Should Spark cut the files differently
    afterwards, reading fails instead of losing a record.
    """
    columns = schema.names if schema is not None else read_csv(spark, *paths, **options).columns
    fields = ", ".join(f"c{i} string" for i in range(len(columns)))
    given = _RECORD_OPTIONS | {name: str(value) for name, value in options.items()}
    text = F.regexp_replace("value", "\r$", "")
    mark = F.when(F.col("record") == 0, F.regexp_replace(text, "^\ufeff", "")).otherwise(text)
    records = csv_records(spark, *paths).select("record", mark.alias("value"))
    parsed = records.withColumn("row", F.from_csv("value", fields, given))
    is_row = F.when(F.col("record") > 0, F.col("value") != "").otherwise(_is_header(columns))
    return parsed.where(is_row).select(*(F.col(f"row.c{i}").alias(name) for i, name in enumerate(columns)))


#: Splits of a file from which reading it in splits is worth the passes.
MANY_SPLITS = 4


def has_large_files(spark: SparkSession, source: str) -> bool:
    """Whether a file below ``source`` has many splits; only names and sizes are looked at."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    largest = listed.agg(F.max("length")).first()[0] or 0
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return largest >= MANY_SPLITS * split


def _is_header(columns: list[str]) -> Column:
    """False for the first record of a file, which is no row; an error if it names other columns."""
    same = F.lit(True)
    for i, name in enumerate(columns):
        same &= F.lower(F.coalesce(F.col(f"row.c{i}"), F.lit(f"_c{i}"))) == name.lower()
    wrong = F.raise_error(F.concat(F.lit("the header of a file names other columns: "), F.col("value")))
    return F.when(same, F.lit(False)).otherwise(wrong.cast("boolean"))


def read_csv_wide(spark: SparkSession, *paths: str, max_chars: int | None = None,
                  max_columns: int | None = None, **options) -> DataFrame:
    """As :func:`read_csv`, with optional limits.

    A file with a field of more than ``max_chars`` characters or a row of more than
    ``max_columns`` columns then fails; without them Spark's own limits hold, which are none
    for characters and 20 480 columns.
    """
    limits = {"maxCharsPerColumn": max_chars, "maxColumns": max_columns}
    return read_csv(spark, *paths, **{k: v for k, v in limits.items() if v is not None}, **options)


def read_csv_by_header(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """Files whose headers name the same columns in any order, or not all of them.

    Each path is a file or a folder of files with one header.  Columns are matched by name; one
    that a path lacks is NULL there.
    """
    parts = [read_csv(spark, path, **options) for path in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def csv_writer(df: DataFrame) -> DataFrameWriter:
    """Writer whose output :func:`read_csv` reads back unchanged, outer blanks included.

    Only empty texts come back as NULL: CSV as read here does not tell them apart.  Both are
    written in quotes, so that a row of one NULL is not an empty line, which readers skip.
    """
    return df.write.options(
        header=True,
        escape='"',
        nullValue='""',
        emptyValue='""',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    csv_writer(df).mode(mode).csv(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One folder or an explicit list of files."""
    return spark.read.parquet(*paths)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def accumulate_parquet(batches: Iterable[DataFrame], path: str) -> int:
    """Write batches into one folder: the first replaces its content, later ones append."""
    written = 0
    for batch in batches:
        batch.write.mode("append" if written else "overwrite").parquet(path)
        written += 1
    return written


def read_accumulated(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches in a folder, which may differ in columns; what one lacks is NULL there.

    Where the folder keeps records of its lots, those are read and nothing else; else all Parquet
    files below it.
    """
    if committed_lots(spark, path) is not None:
        return read_committed(spark, path)
    return read_lot(spark, path, recursive=True)


def sized(df: DataFrame) -> DataFrame:
    """The rows dealt anew into partitions of the session's advisory size, so that files come out even.

    Few rows make one file and many make many, whatever the tasks before; a partition that would be
    too large is split, so no task gets all.  Needs adaptive execution, which is Spark's default;
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is the caller's to set.
    """
    return df.hint("rebalance")


def export_parquet(df: DataFrame, path: str, single_file: bool) -> None:
    """Overwrite ``path`` with files of even size, or one file when asked; that passes all rows through
    one task."""
    (df.coalesce(1) if single_file else sized(df)).write.mode("overwrite").parquet(path)
