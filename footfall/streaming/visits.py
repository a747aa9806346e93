"""Parquet lots to the KPI table: everything at once, or only new files."""

import json

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from footfall import contract
from footfall.contract import KEY_COLUMNS
from footfall.plans.visits import visit_kpi
from footfall.sources.files import write_parquet
from footfall.sources.lots import escape_glob, footers, parquet_files, read_lot, require_columns_in
from footfall.sources.manifest import merged_schema, read_text, storage, write_text
from footfall.streaming.events import EventSink, event_rows
from footfall.streaming.progress import counted, observed, run_reported

NEEDED = [*KEY_COLUMNS, "hits"]
_SEEN, _SCHEMA = "footers/files", "footers/schema.json"


def rebuild_kpi(
    spark: SparkSession, source: str, target: str, dialect: str = "python_literal"
) -> None:
    """Replace ``target`` by the KPI rows of all files in ``source``, in one job.

    Files may differ in columns; one that lacks a key or the hits raises ``ValueError``.
    """
    require_columns_in(footers(parquet_files(spark, source)), NEEDED)
    write_parquet(visit_kpi(read_lot(spark, source), dialect), target)


def source_schema(spark: SparkSession, source: str, checkpoint: str) -> StructType:
    """All columns of the files in ``source``; ``ValueError`` if one lacks a key or the hits.

    What earlier calls have found is kept in the checkpoint's folder, so that only the footers of
    files that are new, or written anew, are read; tasks read them.
    """
    folder = checkpoint.rstrip("/")
    seen, files = storage(spark, f"{folder}/{_SEEN}/_SUCCESS")  # there once a write has ended
    listed = parquet_files(spark, source)
    known = read_text(spark, f"{folder}/{_SCHEMA}") if files.exists(seen) else None
    if known is None:
        new = listed
    else:
        new = listed.join(spark.read.parquet(f"{folder}/{_SEEN}"), ["path", "modified", "length"], "left_anti")
    found = footers(new)
    require_columns_in(found, NEEDED)
    if known is None:
        schema = read_lot(spark, source).schema
    else:
        schema = StructType.fromJson(json.loads(known))
        paths = [escape_glob(row.path) for row in found.select("path").toLocalIterator()]
        if paths:
            schema = merged_schema([schema, read_lot(spark, *paths).schema])
    # the schema first: what a file that counts as seen has must be in it
    text = schema.json()
    if text != known:
        write_text(spark, f"{folder}/{_SCHEMA}", text)
    if not found.isEmpty():
        checked = listed.join(found.select("path"), "path", "left_semi")
        checked.write.mode("append").parquet(f"{folder}/{_SEEN}")
    return schema


def append_new_kpi(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    dialect: str = "python_literal",
    schema: StructType | None = None,
    emit: EventSink | None = None,
) -> StreamingQuery:
    """Append the KPI rows of files not seen before; returns the finished query.

    ``checkpoint`` remembers the files done, and the Parquet sink adds each batch exactly
    once, so a restart neither repeats nor loses rows.  Any failure stops the run.  Do not
    share ``target`` with :func:`rebuild_kpi`.

    Files may differ in columns.  Without ``schema`` it is that of :func:`source_schema`, and a file
    that lacks a key or the hits raises ``ValueError`` before anything is written; the cost of a
    run follows the new files.  With ``schema`` no footer is read; what a file lacks is then NULL.

    ``emit`` is handed the progress events of the monitored job, made of what Spark reports of each
    batch: the rows and NULLs are counted in the batch's own pass (see
    :mod:`footfall.streaming.progress`).
    """
    if emit:
        emit(event_rows(spark, [{
            "evento": contract.RUN_STARTED, "total_archivos": parquet_files(spark, source).count(),
            "tamaño_lote": files_per_batch,
        }]))
    if schema is None:
        schema = source_schema(spark, source, checkpoint)
    visits = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    kpi = counted(visit_kpi(observed(visits), dialect)) if emit else visit_kpi(visits, dialect)
    writer = (
        kpi.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if emit:
        return run_reported(spark, writer, emit, checkpoint, visits, kpi)
    query = writer.start()
    query.awaitTermination()
    return query
