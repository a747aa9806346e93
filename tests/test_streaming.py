import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from footfall import contract
from footfall.plans import visit_kpi
from footfall.sources import read_accumulated, read_parquet
from footfall.streaming import monitored
from footfall.streaming import (
    append_new_kpi, as_json_lines, decode_events, deliver_events, event_rows, json_event_log,
    kafka_event_sink, kafka_event_source, read_event_log, rebuild_kpi, retry_failed,
    run_monitored_kpi,
)


@pytest.fixture
def lots(spark, raw, tmp_path):
    """Three raw files of two visits each; one visit of the second has no key."""
    for lot in range(3):
        rows = [{"visitId": f"{lot}-0"}, {"visitId": None if lot == 1 else f"{lot}-1"}]
        raw(*rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
    return f"{tmp_path}/raw"


def same(left, right):
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_microbatches_give_the_batch_result(spark, raw, lots, tmp_path):
    folders = lots, f"{tmp_path}/kpi", f"{tmp_path}/progress"
    query = append_new_kpi(spark, *folders, files_per_batch=1)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    wanted = visit_kpi(read_parquet(spark, lots))
    assert same(read_parquet(spark, f"{tmp_path}/kpi"), wanted) and wanted.count() == 5

    append_new_kpi(spark, *folders)  # nothing new
    assert read_parquet(spark, f"{tmp_path}/kpi").count() == 5
    raw({"visitId": "new"}).write.mode("append").parquet(lots)
    append_new_kpi(spark, *folders)
    assert read_parquet(spark, f"{tmp_path}/kpi").count() == 6


def test_rebuild_replaces(spark, lots, tmp_path):
    for _ in range(2):
        rebuild_kpi(spark, lots, f"{tmp_path}/kpi")
        assert same(read_parquet(spark, f"{tmp_path}/kpi"), visit_kpi(read_parquet(spark, lots)))


def run(spark, source, tmp_path, **options):
    options = {"files_per_batch": 1, **options}
    run_monitored_kpi(spark, source, json_event_log(f"{tmp_path}/events"),
                      f"{tmp_path}/progress", f"{tmp_path}/kpi", **options)
    lines = [row[0] for row in spark.read.text(f"{tmp_path}/events").collect()]
    return sorted(map(json.loads, lines), key=lambda event: event["timestamp"])


def test_progress_events(spark, lots, tmp_path):
    events = run(spark, lots, tmp_path)
    per_batch = ["inicio_lote", "stats_dataframe", "resultado_limpieza", "fin_lote"]
    assert sorted(e["evento"] for e in events) == sorted(["inicio_proceso"] + per_batch * 3)
    start = events[0]
    assert set(start) == {"evento", "timestamp", "total_archivos", "tamaño_lote"}
    assert (start["total_archivos"], start["tamaño_lote"]) == (3, 1)
    by_lot = {(e["lote_id"], e["evento"]): e for e in events[1:]}
    assert set(by_lot) == {(lot, tag) for lot in (1, 2, 3) for tag in per_batch}
    assert set(by_lot[1, "inicio_lote"]) == {"evento", "timestamp", "lote_id", "archivos"}
    names = [by_lot[lot, "inicio_lote"]["archivos"] for lot in (1, 2, 3)]
    assert all(len(n) == 1 and n[0].endswith(".parquet") and "/" not in n[0] for n in names)

    stats = by_lot[2, "stats_dataframe"]
    raw = read_parquet(spark, lots)
    assert set(stats) == {"evento", "timestamp", "lote_id", "filas_originales", "columnas",
                          "campos_nulos"}
    assert stats["filas_originales"] == 2 and stats["columnas"] == raw.columns
    assert stats["campos_nulos"] == {name: int(name == "visitId") for name in raw.columns}
    result = by_lot[2, "resultado_limpieza"]
    assert (result["filas_finales"], result["columnas_finales"]) == (1, contract.KPI_COLUMNS)
    assert set(by_lot[2, "fin_lote"]) == {"evento", "timestamp", "lote_id", "duracion_segundos"}
    assert by_lot[2, "fin_lote"]["duracion_segundos"] > 0
    assert same(read_accumulated(spark, f"{tmp_path}/kpi"), visit_kpi(raw))

    again = run(spark, lots, tmp_path)  # nothing new: only the start event is added
    assert len(again) == len(events) + 1


def test_counting_only(spark, lots, tmp_path):
    run_monitored_kpi(spark, lots, json_event_log(f"{tmp_path}/events"), f"{tmp_path}/progress",
                      files_per_batch=10)
    events = read_event_log(spark, f"{tmp_path}/events")
    assert events.agg(F.sum("filas_originales"), F.sum("filas_finales")).first() == (6, 5)
    assert not (tmp_path / "kpi").exists()


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_a_bad_file_does_not_stop_the_others(spark, lots, raw, tmp_path, files_per_batch):
    options = {"files_per_batch": files_per_batch, "on_error": "skip",
               "failed": f"{tmp_path}/failed"}
    (tmp_path / "raw" / "damaged.parquet").write_text("this is no Parquet file")
    raw({}).drop("hits").coalesce(1).write.mode("append").parquet(lots)
    events = run(spark, lots, tmp_path, **options)
    errors = [e for e in events if e["evento"] == "error"]
    assert len(errors) == 2
    assert all(set(e) == {"evento", "timestamp", "lote_id", "archivos", "detalle", "stacktrace"}
               for e in errors)
    assert ["damaged.parquet"] in [e["archivos"] for e in errors]
    assert any("hits" in e["detalle"] for e in errors)
    assert read_accumulated(spark, f"{tmp_path}/kpi").count() == 5
    run(spark, lots, tmp_path, **options)  # done with
    assert read_accumulated(spark, f"{tmp_path}/kpi").count() == 5

    damaged = tmp_path / "raw" / "damaged.parquet"
    damaged.write_bytes(read_bytes_with_rows(spark, tmp_path, raw))
    for crc in (tmp_path / "raw").glob(".damaged*"):
        crc.unlink()
    for _ in range(2):
        still = retry_failed(spark, f"{tmp_path}/failed", f"{tmp_path}/kpi")
        assert len(still) == 1 and "damaged" not in still[0]
        assert read_accumulated(spark, f"{tmp_path}/kpi").count() == 6


def read_bytes_with_rows(spark, tmp_path, raw):
    raw({"visitId": "mended"}).coalesce(1).write.parquet(f"{tmp_path}/mended")
    return next((tmp_path / "mended").glob("part-*.parquet")).read_bytes()


def test_a_pass_that_fails_is_taken_by_halves(spark, lots, tmp_path, monkeypatch):
    really, culprit = monitored._one_pass, sorted(
        path.name for path in (tmp_path / "raw").glob("part-*.parquet"))[0]

    def picky(spark, paths, *args):
        if any(path.endswith(culprit) for path in paths):
            raise RuntimeError("bad page")
        return really(spark, paths, *args)

    monkeypatch.setattr(monitored, "_one_pass", picky)
    events = run(spark, lots, tmp_path, files_per_batch=100, on_error="skip",
                 failed=f"{tmp_path}/failed")
    assert [e["archivos"] for e in events if e["evento"] == "error"] == [[culprit]]
    want = visit_kpi(read_parquet(spark, *(
        str(path) for path in (tmp_path / "raw").glob("part-*.parquet") if path.name != culprit)))
    assert same(read_accumulated(spark, f"{tmp_path}/kpi"), want)
    final = [e for e in events if e["evento"] == "resultado_limpieza"]
    assert [e["filas_finales"] for e in final] == [want.count()]


def test_a_new_checkpoint_starts_afresh(spark, lots, tmp_path):
    run(spark, lots, tmp_path)
    for number in (1, 2):
        run_monitored_kpi(spark, lots, lambda events: None, f"{tmp_path}/other{number}",
                          f"{tmp_path}/kpi")
        assert read_accumulated(spark, f"{tmp_path}/kpi").count() == 5
    with pytest.raises(ValueError, match="checkpoint"):
        run(spark, lots, tmp_path)


def test_names_with_glob_characters(spark, raw, tmp_path):
    raw({"visitId": "1"}).coalesce(1).write.parquet(f"{tmp_path}/one")
    (tmp_path / "raw").mkdir()
    for name in ("g[1].parquet", "h{a,b}.parquet", "i*.parquet"):
        source = next((tmp_path / "one").glob("part-*.parquet"))
        (tmp_path / "raw" / name).write_bytes(source.read_bytes())
    run(spark, f"{tmp_path}/raw", tmp_path, files_per_batch=2)
    assert read_accumulated(spark, f"{tmp_path}/kpi").count() == 3


def test_files_that_differ_in_columns(spark, raw, tmp_path):
    source = f"{tmp_path}/raw"
    raw({"visitId": "1"}).coalesce(1).write.parquet(source)
    raw({"visitId": "2"}).drop("totals").coalesce(1).write.mode("append").parquet(source)
    rebuild_kpi(spark, source, f"{tmp_path}/kpi1")
    append_new_kpi(spark, source, f"{tmp_path}/kpi2", f"{tmp_path}/done")
    for folder in ("kpi1", "kpi2"):
        rows = read_parquet(spark, f"{tmp_path}/{folder}").orderBy("visitId").collect()
        assert [(r.visitId, r.visits) for r in rows] == [("1", 1), ("2", None)]
    raw({"visitId": "3"}).drop("hits").coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(ValueError, match="hits"):
        rebuild_kpi(spark, source, f"{tmp_path}/kpi1")
    with pytest.raises(ValueError, match="hits"):
        append_new_kpi(spark, source, f"{tmp_path}/kpi3", f"{tmp_path}/done3")


def test_a_stopped_run_repeats_the_failed_batch(spark, lots, tmp_path):
    damaged = tmp_path / "raw" / "damaged.parquet"
    damaged.write_text("this is no Parquet file")
    with pytest.raises(PySparkException):
        run(spark, lots, tmp_path, on_error="fail")
    good = next(path for path in (tmp_path / "raw").glob("part-*.parquet"))
    damaged.write_bytes(good.read_bytes())
    for crc in (tmp_path / "raw").glob(".damaged*"):
        crc.unlink()
    run(spark, lots, tmp_path, on_error="fail")
    kept = read_accumulated(spark, f"{tmp_path}/kpi").count()
    assert kept == visit_kpi(read_parquet(spark, lots)).count()


def test_a_batch_survives_passing_failures(spark, lots, tmp_path, monkeypatch):
    calls, really = [], monitored._one_pass

    def shaky(*args):
        calls.append(args)
        if len(calls) % 3:
            raise RuntimeError("executor lost")
        return really(*args)

    monkeypatch.setattr(monitored, "_one_pass", shaky)
    events = run(spark, lots, tmp_path)
    assert len(calls) == 9 and "error" not in [e["evento"] for e in events]
    assert read_accumulated(spark, f"{tmp_path}/kpi").count() == 5


def test_a_failing_sink_stops_the_run(spark, lots, tmp_path):
    def emit(events):
        if events.filter(F.col("evento") == "fin_lote").count():
            raise RuntimeError("no broker")

    folders = f"{tmp_path}/progress", f"{tmp_path}/kpi"
    with pytest.raises(PySparkException, match="no broker"):
        run_monitored_kpi(spark, lots, emit, *folders)
    run_monitored_kpi(spark, lots, lambda events: None, *folders)
    assert read_accumulated(spark, f"{tmp_path}/kpi").count() == 5


def test_on_error_is_checked(spark):
    with pytest.raises(ValueError, match="on_error"):
        run_monitored_kpi(spark, "x", print, "y", on_error="ignore")
    with pytest.raises(ValueError, match="failed"):
        run_monitored_kpi(spark, "x", print, "y", on_error="skip")


def test_events_are_stamped_in_utc(spark):
    from datetime import datetime, timezone
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        line = as_json_lines(event_rows(spark, [{"evento": "fin_lote", "lote_id": 1}])).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    stamp = datetime.fromisoformat(json.loads(line)["timestamp"])
    assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - stamp).total_seconds()) < 60


def test_event_stream(spark, tmp_path):
    json_event_log(f"{tmp_path}/topic")(event_rows(spark, [
        {"evento": "inicio_proceso", "total_archivos": 2, "tamaño_lote": 1},
        {"evento": "stats_dataframe", "lote_id": 1, "campos_nulos": {"a": 3, "b": 0}}]))
    spark.createDataFrame([("{broken",), ("[]",)], "value string").write.mode("append").text(
        f"{tmp_path}/topic")
    for _ in range(2):  # the second run finds nothing new
        messages = spark.readStream.text(f"{tmp_path}/topic").select(
            F.col("value").cast("binary").alias("value"))
        deliver_events(decode_events(messages), f"{tmp_path}/out", f"{tmp_path}/progress",
                       available_now=True).awaitTermination()
    rows = read_parquet(spark, f"{tmp_path}/out").collect()
    assert len(rows) == 4
    by_tag = {row["evento"]: row for row in rows}
    assert by_tag["inicio_proceso"]["tamaño_lote"] == 1
    assert by_tag["stats_dataframe"]["campos_nulos"] == {"a": 3, "b": 0}
    assert by_tag[None]["timestamp"] is None
    told = decode_events(spark.read.text(f"{tmp_path}/topic"), unreadable="text")
    assert sorted(r.text or "" for r in told.collect()) == ["", "", "[]", "{broken"]


def test_kafka_ends_need_only_the_connector(spark):
    with pytest.raises(PySparkException, match="kafka"):
        kafka_event_source(spark, "broker:9092").load()
    with pytest.raises(PySparkException, match="kafka"):
        kafka_event_sink(event_rows(spark, [{"evento": "error"}]), "broker:9092").save()
