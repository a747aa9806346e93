import datetime
import glob
import os

import pytest
from pyspark.errors import AnalysisException

from footfall.plans import (
    StarTables, build_star, channel_dimension, date_dimension, extend_star, load_lots, page_dimension,
    visit_facts, visit_kpi, visitor_dimension,
)
from footfall.scratch import new_database
from footfall.sources import (
    append_table, export_parquet, read_parquet, read_table, sized, write_table,
)

SENTINEL = "not available in demo dataset"


@pytest.fixture
def kpi(raw):
    return visit_kpi(raw(
        {"visitId": "1"},
        {"visitId": "2", "date": "bad", "channelGrouping": SENTINEL},
        {"visitId": "3", "date": "20170230", "socialEngagementType": "Socially Engaged"},
        {"visitId": "4", "date": None, "hits": None},
        {"visitId": "4", "date": None, "hits": None, "channelGrouping": None},
    ))


def test_date_dimension_is_distinct_before_parsing(kpi):
    rows = sorted(map(tuple, date_dimension(kpi).collect()), key=repr)
    assert rows == [(None,) * 5] * 3 + [(datetime.date(2017, 1, 1), 2017, 1, 1, "Sunday")]


def test_dimensions_keep_null_as_a_member(kpi):
    assert sorted(map(repr, (row[0] for row in channel_dimension(kpi).collect()))) == [
        "'Direct'", "None"]
    assert visitor_dimension(kpi).count() == 2
    pages = page_dimension(kpi)
    assert pages.columns == ["url_pagina", "pagina_referida", "isInteraction"]
    assert sorted(map(tuple, pages.collect()), key=repr) == [
        ("/a", None, None), (None, None, None)]


def test_facts_are_not_deduplicated(kpi):
    facts = visit_facts(kpi)
    assert facts.count() == 5
    assert dict(facts.dtypes)["date"] == "string" and "pagePath" not in facts.columns


def test_every_fact_finds_its_dimension_rows(kpi):
    facts = visit_facts(kpi)
    for dimension, keys in [(channel_dimension(kpi), ["channelGrouping"]),
                            (visitor_dimension(kpi), ["fullVisitorId"])]:
        same = [facts[key].eqNullSafe(dimension[key]) for key in keys]
        assert facts.join(dimension, same, "left_anti").count() == 0


def test_build(spark, kpi, tmp_path):
    database = new_database(spark, "star")
    lots = [f"{database}.kpi_lote_01", f"{database}.kpi_lote_02"]
    kpi.filter("visitId < '3'").write.parquet(f"{tmp_path}/1")
    kpi.filter("visitId >= '3'").select(kpi.columns[::-1]).write.parquet(f"{tmp_path}/2")
    load_lots(spark, [f"{tmp_path}/1", f"{tmp_path}/2"], lots)
    tables = StarTables.in_database(database)
    for _ in range(2):  # a second build replaces the first
        counts = build_star(spark, lots, tables, f"{tmp_path}/export")
        assert dict(map(tuple, counts.collect())) == {
            "kpi_total_unificado": 5, "hechos_visitas": 5, "dim_tiempo": 4,
            "dim_visitante": 2, "dim_canal": 2, "dim_pagina": 2}
    assert read_table(spark, tables.unified).exceptAll(kpi).count() == 0
    for name in ("hechos_visitas", "dim_tiempo", "dim_visitante", "dim_canal", "dim_pagina"):
        exported = read_parquet(spark, f"{tmp_path}/export/{name}")
        if name in ("dim_tiempo", "dim_canal"):
            assert len(exported.inputFiles()) == 1
        assert exported.exceptAll(read_table(spark, f"{database}.{name}")).count() == 0


def test_lots_must_have_the_same_columns(spark, kpi):
    database = new_database(spark, "star")
    write_table(kpi, f"{database}.a")
    write_table(kpi.drop("visits"), f"{database}.b")
    with pytest.raises(AnalysisException):
        build_star(spark, [f"{database}.a", f"{database}.b"], StarTables.in_database(database))


def test_extending_a_star_equals_building_it(spark, kpi, raw, tmp_path):
    database = new_database(spark, "star")
    more = visit_kpi(raw(
        {"visitId": "6", "date": "bad"}, {"visitId": "7", "date": "worse"}, {"visitId": "8", "date": None},
        {"visitId": "9", "date": "20170101"}, {"visitId": "10", "date": "20170102", "hits": None},
        {"visitId": "11", "channelGrouping": "Social", "fullVisitorId": "u2"}))
    last = visit_kpi(raw({"visitId": "12", "date": "worse", "channelGrouping": None, "fullVisitorId": "u2"}))
    lots = [f"{database}.{name}" for name in ("a", "b", "c")]
    for rows, name in zip((kpi, more.select(more.columns[::-1]), last), lots, strict=True):
        write_table(rows, name)
    grown, whole = (StarTables.in_database(new_database(spark, name)) for name in ("grown", "whole"))
    build_star(spark, lots[:1], grown)
    extend_star(spark, lots[1:2], grown)
    counts = extend_star(spark, lots[2:], grown)
    wanted = build_star(spark, lots, whole)
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, wanted.collect()))
    for one, two in zip(grown.all(), whole.all(), strict=True):
        rows = read_table(spark, one).select(read_table(spark, two).columns)
        assert rows.exceptAll(read_table(spark, two)).count() == 0


def test_an_unfinished_star_is_not_extended(spark, kpi):
    database = new_database(spark, "star")
    write_table(kpi, f"{database}.a")
    tables = StarTables.in_database(database)
    build_star(spark, [f"{database}.a"], tables)
    append_table(visit_facts(kpi), tables.fact)
    with pytest.raises(ValueError, match="build the star anew"):
        extend_star(spark, [f"{database}.a"], tables)


def test_appended_columns_go_by_name(spark, kpi):
    name = f"{new_database(spark, 'append')}.a"
    write_table(kpi, name)
    append_table(kpi.select("visitId", "date"), name)
    assert read_table(spark, name).where("fullVisitorId IS NULL").count() == 5
    with pytest.raises(ValueError, match="no columns extra"):
        append_table(kpi.withColumn("extra", kpi.visitId), name)


def test_exports_come_in_even_files(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 3).selectExpr("id", "CAST(sha2(CAST(id AS STRING), 256) AS STRING) AS t")
    skewed = rows.where("id < 390000").coalesce(1).union(rows.where("id >= 390000"))
    assert "REBALANCE" in sized(skewed)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        export_parquet(skewed, f"{tmp_path}/many", single_file=False)
        export_parquet(rows.limit(10), f"{tmp_path}/few", single_file=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sizes = [os.path.getsize(p) for p in glob.glob(f"{tmp_path}/many/*.parquet")]
    assert len(sizes) > 3 and max(sizes) < 3 * min(sizes)
    assert len(glob.glob(f"{tmp_path}/few/*.parquet")) == 1
    assert read_parquet(spark, f"{tmp_path}/many").count() == 400_000
