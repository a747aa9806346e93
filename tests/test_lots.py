import json
import os

import pytest
from pyspark.sql import types as T

from footfall.plans import visit_kpi
from footfall.sources import lots, read_accumulated, read_lot
from footfall.sources.manifest import (
    commit_lot, committed_lots, forget_lot, merged_schema, read_committed, read_text, write_text,
)
from footfall.streaming import append_new_kpi, json_event_log, read_event_log, rebuild_kpi
from footfall.streaming.visits import source_schema


def write(raw, folder, *rows, drop=()):
    raw(*rows).drop(*drop).coalesce(1).write.mode("append").parquet(folder)


def files_of(folder):
    return sorted(f"{folder}/{name}" for name in os.listdir(folder) if name.endswith(".parquet"))


def test_footers_tell_columns_and_broken_files(spark, raw, tmp_path):
    folder = f"{tmp_path}/lots [1] a%20b"
    write(raw, folder, {}, drop=["hits", "totals"])
    write(raw, folder, {})
    with open(f"{folder}/broken.parquet", "wb") as file:
        file.write(b"PAR1 no footer PAR1")
    found = lots.footers(lots.parquet_files(spark, lots.escape_glob(folder)))
    problems = {os.path.basename(r.path): r.problem for r in lots.lacking(found, ["visitId", "hits", "totals"]).collect()}
    assert problems.pop("broken.parquet").startswith("is no Parquet file")
    assert list(problems.values()) == ["lacks hits, totals"]
    with pytest.raises(ValueError, match="2 files lack columns"):
        lots.require_columns_in(found, ["hits"])
    lots.require_columns_in(found.where("error IS NULL"), ["visitId"])


def test_a_file_that_tasks_cannot_open_is_read_by_spark(spark, raw, tmp_path, monkeypatch):
    write(raw, f"{tmp_path}/in", {})

    def refuse(path):
        raise OSError("the store does not answer")

    # tasks carry the module's functions by value, so they get this one
    monkeypatch.setattr(lots, "_opened", refuse)
    found = lots.footers(lots.parquet_files(spark, f"{tmp_path}/in")).collect()
    assert len(found) == 1 and "hits" in found[0]["columns"] and found[0].error is None


def test_incremental_runs_read_new_footers_only(spark, raw, tmp_path):
    source, target, progress = (f"{tmp_path}/{name}" for name in ("raw", "kpi", "progress"))
    write(raw, source, {"visitId": "1"}, drop=["totals"])
    append_new_kpi(spark, source, target, progress)
    old = files_of(source)[0]
    before = os.stat(old)
    with open(old, "r+b") as file:  # as long and as old as it was, but no Parquet file
        file.write(b"x" * before.st_size)
    os.utime(old, ns=(before.st_atime_ns, before.st_mtime_ns))
    for name in os.listdir(source):
        if name.endswith(".crc"):
            os.remove(f"{source}/{name}")
    write(raw, source, {"visitId": "2"})
    append_new_kpi(spark, source, target, progress)
    rows = {r.visitId: r.visits for r in read_lot(spark, target).select("visitId", "visits").collect()}
    assert rows == {"1": None, "2": 1}
    write(raw, source, {"visitId": "3"}, drop=["hits"])
    with pytest.raises(ValueError, match="lacks hits"):
        append_new_kpi(spark, source, target, progress)
    assert read_lot(spark, target).count() == 2


def test_schema_is_kept_and_survives_an_unfinished_call(spark, raw, tmp_path):
    source, progress = f"{tmp_path}/raw", f"{tmp_path}/progress"
    write(raw, source, {}, drop=["totals"])
    # a schema without a list of files is from a call that did not come to its end
    write_text(spark, f"{progress}/footers/schema.json", T.StructType().json())
    first = source_schema(spark, source, progress)
    assert "totals" not in first.names and "hits" in first.names
    write(raw, source, {})
    assert source_schema(spark, source, progress).names == [*first.names, "totals"]
    assert json.loads(read_text(spark, f"{progress}/footers/schema.json"))["fields"][-1]["name"] == "totals"
    assert source_schema(spark, source, progress).names == [*first.names, "totals"]


def test_rebuild_names_files_that_lack_columns(spark, raw, tmp_path):
    write(raw, f"{tmp_path}/raw", {})
    write(raw, f"{tmp_path}/raw", {}, drop=["fullVisitorId"])
    with pytest.raises(ValueError, match="1 files lack columns.*lacks fullVisitorId"):
        rebuild_kpi(spark, f"{tmp_path}/raw", f"{tmp_path}/kpi")


def test_committed_lots_are_read_whole_and_nothing_else(spark, tmp_path):
    target = f"{tmp_path}/lots"
    assert committed_lots(spark, target) is None
    with pytest.raises(ValueError, match="no records"):
        read_committed(spark, target)
    one, two = spark.range(3).selectExpr("id", "'x' AS a"), spark.range(2).selectExpr("id", "id > 0 AS b")
    one.write.parquet(f"{target}/lote-1/todo")
    two.write.parquet(f"{target}/lote-2/todo")
    two.write.parquet(f"{target}/lote-2/unfinished")
    commit_lot(spark, target, "lote-1", one.schema, ["lote-1/todo"], 3)
    assert read_accumulated(spark, target).columns == ["id", "a"]
    commit_lot(spark, target, "lote-2", two.schema, ["lote-2/todo"], 2)
    rows = set(map(tuple, read_accumulated(spark, target).collect()))
    assert rows == {(0, "x", None), (1, "x", None), (2, "x", None), (0, None, False), (1, None, True)}
    assert {r.name: r.rows for r in committed_lots(spark, target).collect()} == {"lote-1": 3, "lote-2": 2}
    commit_lot(spark, target, "lote-2", two.schema, ["lote-2/todo"], 2)  # again
    forget_lot(spark, target, "lote-1")
    assert read_accumulated(spark, target).count() == 2
    forget_lot(spark, target, "lote-2")
    assert read_committed(spark, target).count() == 0


def test_columns_of_one_name_must_have_one_type():
    schema = T.StructType.fromDDL
    assert merged_schema([schema("a int, b string"), schema("B string, c int")]).names == ["a", "b", "c"]
    with pytest.raises(ValueError, match="column a is"):
        merged_schema([schema("a int"), schema("a string")])


def test_events_of_the_append_job(spark, raw, tmp_path):
    for lot in range(12):  # Spark writes a summary of what it has seen at every tenth batch
        write(raw, f"{tmp_path}/raw", {"visitId": f"{lot}-0"}, {"visitId": None if lot == 1 else f"{lot}-1"})
    query = append_new_kpi(spark, f"{tmp_path}/raw", f"{tmp_path}/kpi", f"{tmp_path}/progress", files_per_batch=1,
                           emit=json_event_log(f"{tmp_path}/events"))
    assert not query.isActive
    events = [r.asDict() for r in read_event_log(spark, f"{tmp_path}/events").collect()]
    by_lot = {(e["lote_id"], e["evento"]): e for e in events}
    assert len(by_lot) == len(events) == 1 + 4 * 12
    assert by_lot[None, "inicio_proceso"]["total_archivos"] == 12
    names = [by_lot[lot, "inicio_lote"]["archivos"] for lot in range(1, 13)]
    assert sorted(n for own in names for n in own) == [os.path.basename(p) for p in files_of(f"{tmp_path}/raw")]
    assert all(len(own) == 1 for own in names)
    nulls = [by_lot[lot, "stats_dataframe"]["campos_nulos"]["visitId"] for lot in range(1, 13)]
    rows = [by_lot[lot, "resultado_limpieza"]["filas_finales"] for lot in range(1, 13)]
    assert sorted(nulls) == [0] * 11 + [1] and sorted(rows) == [1] + [2] * 11
    for lot in range(1, 13):
        start, end = by_lot[lot, "inicio_lote"], by_lot[lot, "fin_lote"]
        assert (end["timestamp"] - start["timestamp"]).total_seconds() == pytest.approx(end["duracion_segundos"], abs=0.002)
        assert end["duracion_segundos"] > 0
        assert by_lot[lot, "resultado_limpieza"]["columnas_finales"] == visit_kpi(raw({})).columns
    append_new_kpi(spark, f"{tmp_path}/raw", f"{tmp_path}/kpi", f"{tmp_path}/progress",
                   emit=json_event_log(f"{tmp_path}/more"))
    assert [e.evento for e in read_event_log(spark, f"{tmp_path}/more").collect()] == ["inicio_proceso"]


def test_a_failing_append_job_sends_its_error(spark, raw, tmp_path):
    write(raw, f"{tmp_path}/raw", {})
    with open(files_of(f"{tmp_path}/raw")[0], "r+b") as file:
        file.write(b"broken")
    schema = raw({}).schema
    with pytest.raises(Exception, match="FAILED_READ_FILE|broken|Parquet|parquet"):
        append_new_kpi(spark, f"{tmp_path}/raw", f"{tmp_path}/kpi", f"{tmp_path}/progress", schema=schema,
                       emit=json_event_log(f"{tmp_path}/events"))
    tags = [e.evento for e in read_event_log(spark, f"{tmp_path}/events").collect()]
    assert sorted(tags) == ["error", "inicio_proceso"]
