"""Lots as committed: one record per lot, with its folders and its schema.

A lot counts from the moment its record is in place, which a rename does at once; what an unfinished
or repeated attempt left in a folder is not read.  Readers follow the records instead of listing
folders and reading footers.
"""

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RECORDS = "_lots"


def storage(spark: SparkSession, path: str):
    """A path in Hadoop's terms and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, folder: str) -> None:
    path, files = storage(spark, folder)
    files.delete(path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place, replacing one that is there."""
    aside, files = storage(spark, f"{path}.new")
    stream = files.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    place = storage(spark, path)[0]
    files.delete(place, False)
    if not files.rename(aside, place):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None if there is none."""
    place, files = storage(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def merged_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """The columns of all schemas, in the order they first come; ``ValueError`` if types differ."""
    merged: dict[str, T.StructField] = {}
    for field in (field for schema in schemas for field in schema):
        known = merged.setdefault(field.name.lower(), T.StructField(field.name, field.dataType))
        if known.dataType != field.dataType:
            raise ValueError(f"column {field.name} is {known.dataType.simpleString()} in one lot and "
                             f"{field.dataType.simpleString()} in another")
    return T.StructType(list(merged.values()))


def commit_lot(spark: SparkSession, target: str, name: str, schema: T.StructType,
               folders: Sequence[str], rows: int) -> None:
    """Make ``folders`` of ``target`` the lot ``name``."""
    record = {"name": name, "folders": list(folders), "rows": rows, "schema": schema.json()}
    write_text(spark, f"{target.rstrip('/')}/{RECORDS}/{name}.json", json.dumps(record))


def forget_lot(spark: SparkSession, target: str, name: str) -> None:
    """Take a lot back, before its folder is written anew."""
    remove(spark, f"{target.rstrip('/')}/{RECORDS}/{name}.json")


def committed_lots(spark: SparkSession, target: str) -> DataFrame | None:
    """``name, folders, rows, schema`` of the lots of a target, or None if it keeps no records."""
    folder = f"{target.rstrip('/')}/{RECORDS}"
    place, files = storage(spark, folder)
    if not files.exists(place):
        return None
    return spark.read.schema("name string, folders array<string>, rows long, schema string").option(
        "pathGlobFilter", "*.json").json(folder)


def read_committed(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all committed lots, with every column that any of them has.

    What a lot lacks is NULL for its rows.  A target without records raises ``ValueError``.
    """
    found = committed_lots(spark, target)
    if found is None:
        raise ValueError(f"{target} keeps no records of its lots")
    lots = found.orderBy("name").collect()  # one row per lot
    schemas = dict.fromkeys(lot.schema for lot in lots)
    schema = merged_schema([T.StructType.fromJson(json.loads(text)) for text in schemas])
    folders = [f"{target.rstrip('/')}/{folder}" for lot in lots for folder in lot.folders]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)
