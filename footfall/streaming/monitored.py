"""The KPI job batch by batch, with a progress event around every step."""

import os
import time
import traceback
from collections.abc import Callable
from itertools import batched
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall import contract
from footfall.operators.profile import profile_metrics
from footfall.plans.visits import visit_kpi
from footfall.sources.lots import escape_glob, files_lacking, read_lot
from footfall.sources.manifest import (
    RECORDS, commit_lot, forget_lot, merged_schema, read_text, remove, storage, write_text,
)
from footfall.streaming.events import EventSink, event_rows

Result = TypeVar("Result")
_FILE_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def run_monitored_kpi(
    spark: SparkSession,
    source: str,
    emit: EventSink,
    checkpoint: str,
    target: str | None = None,
    files_per_batch: int = 1000,
    on_error: str = "fail",
    attempts: int = 3,
    dialect: str = "python_literal",
    failed: str | None = None,
) -> None:
    """Process the new Parquet files of ``source``; hand progress events to ``emit``.

    The stream carries file names only.  Each batch reads its files, which may differ in
    columns, as one ordinary DataFrame and makes one pass over them, which counts the raw rows
    and NULLs, computes the KPI rows, counts those and writes them.  Without ``target`` they are
    only counted.

    A batch has its own folder ``<target>/lote-<n>``, emptied if the batch is repeated, and counts once
    its record is among those of the target (see :mod:`footfall.sources.manifest`);
    ``read_accumulated`` reads all that count, whatever their columns.  A target belongs to one checkpoint: with a new one the
    lots of an earlier run are removed first, as nothing of them counts as done; a target that
    another checkpoint goes on filling raises ``ValueError``.

    Files without a key or the hits are bad, and so are those that are no Parquet files; a store that
    does not answer stops the run.  If the pass over the others fails, it is tried
    again, for the cause may be the cluster and not the files; then by halves, until the bad
    files are alone.  Each bad file has its ``error`` event.  With ``on_error="fail"`` the run
    then stops, and a restart repeats the batch, so nothing is lost.  With ``"skip"`` it goes on
    with the rows of all other files; the names of the bad ones are added as text lines to the
    folder ``failed``, from which :func:`retry_failed` takes them up again.  A failing ``emit``
    always stops the run.
    """
    if on_error not in ("skip", "fail"):
        raise ValueError(f"on_error must be 'skip' or 'fail', not {on_error!r}")
    if on_error == "skip" and failed is None:
        raise ValueError("on_error='skip' needs a folder for the names of failed files")

    def send(*events: dict) -> None:
        emit(event_rows(spark, events))

    def process(listing: DataFrame, batch_id: int) -> None:
        # At most files_per_batch names.
        paths = sorted({row["path"] for row in listing.collect()})
        lot = {"lote_id": batch_id + 1}
        names = [os.path.basename(path) for path in paths]
        send({"evento": contract.BATCH_STARTED, **lot, "archivos": names})
        report, bad, commit = _lot(spark, paths, target, f"lote-{batch_id + 1:06d}", dialect, attempts)
        for path, error in bad:
            send({
                "evento": contract.BATCH_FAILED, **lot, "archivos": [os.path.basename(path)],
                "detalle": str(error), "stacktrace": "".join(traceback.format_exception(error)),
            })
        if bad and on_error == "fail":
            raise bad[0][1]
        if bad:
            spark.createDataFrame([(path,) for path, _ in bad], "value string").coalesce(1) \
                .write.mode("append").text(failed)
        commit()
        send(*({**event, **lot} for event in report))

    if target:
        _claim(spark, target, checkpoint)
    glob = {"pathGlobFilter": "*.parquet"}
    send({
        "evento": contract.RUN_STARTED,
        "total_archivos": spark.read.format("binaryFile").options(**glob).load(source).count(),
        "tamaño_lote": files_per_batch,
    })
    query = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_LISTING)
        .options(**glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("__globPaths__", False)  # else a batch skips files whose names look like patterns
        .load(source)
        .select("path")
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def retry_failed(
    spark: SparkSession, failed: str, target: str | None, attempts: int = 3,
    dialect: str = "python_literal", files_per_batch: int = 1000,
) -> list[str]:
    """Process the files named in the folder ``failed`` again, as lots ``<target>/lote-otra-<n>``.

    Returns the names that still fail.  These lots are replaced each time, so a second call after
    mending more files loses none.
    """
    names = (row.value for row in spark.read.text(failed).distinct().orderBy("value").toLocalIterator())
    if target:
        place, files = storage(spark, f"{target.rstrip('/')}/{RECORDS}/lote-otra-*.json")
        for status in files.globStatus(place) or []:
            files.delete(status.getPath(), False)
    still = []
    for number, paths in enumerate(batched(names, files_per_batch), 1):
        _, bad, commit = _lot(spark, list(paths), target, f"lote-otra-{number:06d}", dialect, attempts)
        commit()
        still += [path for path, _ in bad]
    return still


_MARK = "_checkpoint"


def _claim(spark: SparkSession, target: str, checkpoint: str) -> None:
    """Make ``target`` the output of ``checkpoint``; a new checkpoint starts with no lots."""
    folder = target.rstrip("/")
    owner = read_text(spark, f"{folder}/{_MARK}")
    mine, checkpoints = storage(spark, f"{checkpoint.rstrip('/')}/metadata")
    if checkpoints.exists(mine):
        if owner not in (None, checkpoint):
            raise ValueError(f"{target} holds the lots of checkpoint {owner}, not of {checkpoint}")
    else:
        remove(spark, f"{folder}/{RECORDS}")
        place, files = storage(spark, f"{folder}/lote-*")
        for status in files.globStatus(place) or []:
            files.delete(status.getPath(), True)
    if owner != checkpoint:
        write_text(spark, f"{folder}/{_MARK}", checkpoint)


def _lot(
    spark: SparkSession, paths: list[str], target: str | None, name: str, dialect: str, attempts: int
) -> tuple[list[dict], list[tuple[str, Exception]], Callable[[], None]]:
    """Process files as one lot: its events, the bad files, and what makes the lot count."""
    folder = f"{target.rstrip('/')}/{name}" if target else None
    if target:
        forget_lot(spark, target, name)
        remove(spark, folder)
    report, bad, parts = _isolated(spark, paths, folder, dialect, attempts)

    def commit() -> None:
        if target and parts:
            rows = sum(event.get("filas_finales", 0) for event in report)
            commit_lot(spark, target, name, merged_schema(list(parts.values())),
                       [f"{name}/{part}" for part in parts], rows)

    return report, bad, commit


def _isolated(
    spark: SparkSession, paths: list[str], folder: str | None, dialect: str, attempts: int
) -> tuple[list[dict], list[tuple[str, Exception]], dict[str, StructType]]:
    """The events of all files that can be processed, the bad files with their errors, and the folders
    written with their schemas."""
    lacking = files_lacking(spark, paths, [*contract.KEY_COLUMNS, "hits"])
    bad: list[tuple[str, Exception]] = [
        (path, ValueError(f"{path} {problem}")) for path, problem in lacking.items()]
    reports, parts = [], {}
    todo = [([path for path in paths if path not in lacking], "todo")]
    while todo:
        some, part = todo.pop()
        if not some:
            continue
        try:
            own = f"{folder}/{part}" if folder else None
            report, parts[part] = _retried(lambda s=some, o=own: _one_pass(spark, s, o, dialect), attempts)
            reports.append(report)
        except Exception as error:
            if folder:
                remove(spark, f"{folder}/{part}")
            if len(some) == 1:
                bad.append((some[0], error))
            else:
                half = len(some) // 2
                todo += [(some[half:], f"{part}-b"), (some[:half], f"{part}-a")]
    return _summed(reports), sorted(bad, key=lambda item: item[0]), parts


def _summed(reports: list[list[dict]]) -> list[dict]:
    """The events of one pass, from those of passes over parts of the files."""
    if not reports:
        return []
    profile, result, finished = ([report[i] for report in reports] for i in range(3))
    columns = list(dict.fromkeys(name for event in profile for name in event["columnas"]))
    rows = sum(event["filas_originales"] for event in profile)
    present = {name: sum(event["filas_originales"] - event["campos_nulos"][name]
                         for event in profile if name in event["campos_nulos"]) for name in columns}
    return [
        {**profile[0], "filas_originales": rows, "columnas": columns,
         "campos_nulos": {name: rows - present[name] for name in columns}},
        {**result[0], "filas_finales": sum(event["filas_finales"] for event in result),
         "columnas_finales": list(dict.fromkeys(
             name for event in result for name in event["columnas_finales"]))},
        {**finished[0],
         "duracion_segundos": sum(event["duracion_segundos"] for event in finished)},
    ]


def _retried(work: Callable[[], Result], attempts: int) -> Result:
    """The result of ``work``, tried again after any failure but a wrong set of columns."""
    for _ in range(attempts - 1):
        try:
            return work()
        except AnalysisException:
            raise
        except Exception:
            continue
    return work()


def _one_pass(
    spark: SparkSession, paths: list[str], folder: str | None, dialect: str
) -> tuple[list[dict], StructType]:
    """Write the KPI rows of some files; the events that tell how it went, and the rows' schema."""
    raw = read_lot(spark, *map(escape_glob, paths))
    before, after = Observation(), Observation()
    kpi = visit_kpi(raw.observe(before, *profile_metrics(raw)), dialect)
    counted = kpi.observe(after, F.count(F.lit(1)).alias("n"))

    started = time.monotonic()
    writer = counted.write.mode("overwrite")
    if folder:
        writer.parquet(folder)
    else:
        writer.format("noop").save()
    seconds = time.monotonic() - started

    return [
        {
            "evento": contract.BATCH_PROFILE,
            "filas_originales": before.get["n"],
            "columnas": raw.columns,
            "campos_nulos": {
                name: before.get[f"n_{i}"] for i, name in enumerate(raw.columns)
            },
        },
        {
            "evento": contract.BATCH_RESULT,
            "filas_finales": after.get["n"],
            "columnas_finales": kpi.columns,
        },
        {"evento": contract.BATCH_FINISHED, "duracion_segundos": seconds},
    ], kpi.schema
