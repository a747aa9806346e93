"""Progress events of a stream that Spark runs on its own, from what it reports of each batch."""

import os
import queue
import threading
import traceback
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from footfall import contract
from footfall.operators.profile import profile_metrics
from footfall.streaming.events import EventSink, event_rows

BEFORE, AFTER = "before", "after"
#: Seconds to wait for reports that are still on their way when a query has ended.
PATIENCE = 60


def observed(rows: DataFrame) -> DataFrame:
    """Count the rows and NULLs that a stream reads, in its own pass."""
    return rows.observe(BEFORE, *profile_metrics(rows))


def counted(rows: DataFrame) -> DataFrame:
    """Count the rows that a stream writes."""
    return rows.observe(AFTER, F.count(F.lit(1)).alias("n"))


class _Reports(StreamingQueryListener):
    """Puts the reports of the query of one name into a queue, and None when it has ended."""

    def __init__(self, name: str) -> None:
        self.name, self.run = name, None
        self.reports: queue.Queue = queue.Queue()
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            self.reports.put(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.reports.put(None)


def run_reported(
    spark: SparkSession, writer: DataStreamWriter, emit: EventSink, checkpoint: str, raw: DataFrame,
    result: DataFrame,
) -> StreamingQuery:
    """Start a stream over ``observed(raw)`` that writes ``counted(result)``; returns it finished.

    Each batch gives the events of a monitored batch: its files, rows and NULLs read, rows written, and
    its real duration, stamped with the times of the batch.  They are handed to ``emit`` while the
    stream goes on.  A failure gives an ``error`` event and is raised.
    """
    listener = _Reports(f"kpi-{uuid.uuid4().hex}")
    spark.streams.addListener(listener)
    try:
        query = writer.queryName(listener.name).start()
        try:
            for report in _until_ended(query, listener):
                events = _batch_events(spark, report, checkpoint, raw.columns, result.columns)
                emit(event_rows(spark, events))
            query.awaitTermination()
        except Exception as error:
            query.stop()
            emit(event_rows(spark, [{
                "evento": contract.BATCH_FAILED, "detalle": str(error),
                "stacktrace": "".join(traceback.format_exception(error)),
            }]))
            raise
        return query
    finally:
        spark.streams.removeListener(listener)


def _until_ended(query: StreamingQuery, listener: _Reports) -> Iterator:
    """The reports of all batches with data, in order."""
    waited = 0
    while True:
        try:
            report = listener.reports.get(timeout=1)
        except queue.Empty:
            waited = 0 if query.isActive else waited + 1
            if waited > PATIENCE:
                raise TimeoutError("the end of the query was not reported") from None
            continue
        if report is None:
            return
        if "addBatch" in report.durationMs:
            yield report


def _batch_events(spark: SparkSession, report, checkpoint: str, columns: list[str],
                  result_columns: list[str]) -> list[dict]:
    before, after = report.observedMetrics[BEFORE], report.observedMetrics[AFTER]
    seconds = report.durationMs["triggerExecution"] / 1000
    started = datetime.fromisoformat(report.timestamp)
    ended = started + timedelta(seconds=seconds)
    start, end = (time.replace(tzinfo=None).isoformat() for time in (started, ended))
    lot = {"lote_id": report.batchId + 1}
    return [
        {"evento": contract.BATCH_STARTED, "timestamp": start, **lot,
         "archivos": batch_files(spark, checkpoint, report.batchId)},
        {"evento": contract.BATCH_PROFILE, "timestamp": end, **lot, "filas_originales": before["n"],
         "columnas": columns,
         "campos_nulos": {name: before[f"n_{i}"] for i, name in enumerate(columns)}},
        {"evento": contract.BATCH_RESULT, "timestamp": end, **lot, "filas_finales": after["n"],
         "columnas_finales": result_columns},
        {"evento": contract.BATCH_FINISHED, "timestamp": end, **lot, "duracion_segundos": seconds},
    ]


def batch_files(spark: SparkSession, checkpoint: str, batch: int) -> list[str]:
    """The names of the files of a batch, as the checkpoint of a file stream has them.

    Spark notes each batch in a file of its own; every tenth one repeats all before.
    """
    folder = f"{checkpoint.rstrip('/')}/sources/0"
    noted = spark.read.option("pathGlobFilter", f"{{{batch},{batch}.compact}}").text(folder)
    entry = F.from_json("value", "path string, batchId long")
    rows = noted.select(entry.alias("e")).where(F.col("e.batchId") == batch).select("e.path").distinct()
    return sorted(os.path.basename(row.path) for row in rows.toLocalIterator())
