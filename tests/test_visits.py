import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from footfall.contract import KPI_COLUMNS, METRIC_TYPES
from footfall.plans import visit_kpi

SENTINEL = "not available in demo dataset"


def test_columns_and_types(raw):
    assert visit_kpi(raw({})).dtypes == [
        (name, METRIC_TYPES.get(name, "string")) for name in KPI_COLUMNS]


def test_one_row(raw):
    row = visit_kpi(raw({
        "totals": '{"visits": "1", "pageviews": 7, "transactionRevenue": "1e3", "x": "y"}',
        "hits": "{'type': 'PAGE', 'page': {'pagePath': '/a'}, 'isInteraction': True}",
    })).first()
    assert tuple(row) == (
        "u1", "20170101", "1", "1", "1483228800", "Direct", "Not Socially Engaged",
        1, 7, None, 1000.0, "PAGE", "/a", "true", None)


def test_keys(raw):
    rows = visit_kpi(raw(
        {"fullVisitorId": None}, {"visitId": None}, {"visitId": f"x {SENTINEL}"},
        {"fullVisitorId": SENTINEL}, {"visitId": ""}, {"fullVisitorId": "", "visitId": "9"},
    )).collect()
    assert [(row["fullVisitorId"], row["visitId"]) for row in rows] == [("u1", ""), ("", "9")]


def test_placeholder_inside_json_wipes_what_is_derived(raw):
    row = visit_kpi(raw({
        "totals": '{"visits": "1", "note": "%s"}' % SENTINEL,
        "hits": "[{'type': 'A'}, {'type': '%s'}]" % SENTINEL,
        "channelGrouping": SENTINEL,
    })).first().asDict()
    assert row["fullVisitorId"] == "u1"
    assert all(row[name] is None for name in
               ["visits", "pageviews", "hitType", "pagePath", "channelGrouping"])


@pytest.mark.parametrize("totals, visits", [
    ("bad", None), (None, None), ('{"visits":1}', 1), ('{"visits":"1"}', 1),
    ('{"visits":"x"}', None), ('{"visits":"99999999999"}', None), ('{"VISITS":"1"}', None),
    ('{"visits":"2.5"}', 2), ("{'visits': '3'}", 3)])
def test_totals_texts(raw, totals, visits):
    assert [row["visits"] for row in visit_kpi(raw({"totals": totals})).collect()] == [visits]


def test_missing_columns(raw):
    assert visit_kpi(raw({}).drop("channelGrouping", "device")).columns == [
        name for name in KPI_COLUMNS if name != "channelGrouping"]
    assert "visits" not in visit_kpi(raw({}).drop("totals")).columns
    for name in ("hits", "visitId", "fullVisitorId"):
        with pytest.raises(AnalysisException, match=name):
            visit_kpi(raw({}).drop(name))
    with pytest.raises(AnalysisException, match="hits"):
        visit_kpi(raw({}).withColumnRenamed("hits", "Hits"))


def test_typed_totals_are_an_option(raw):
    struct = F.struct(F.lit("5").alias("visits"), F.lit(2.9).alias("pageviews"),
                      F.lit("1.5").alias("transactionRevenue"))
    nested = raw({}).withColumn("totals", struct)
    assert "visits" not in visit_kpi(nested).columns
    row = visit_kpi(nested, typed_totals=True).first()
    assert (row["visits"], row["pageviews"], row["transactionRevenue"]) == (5, 2, 1.5)

    flat = raw({}).drop("totals").withColumns({"visits": F.lit("x"), "transactions": F.lit(3)})
    assert "visits" not in visit_kpi(flat).columns
    typed = visit_kpi(flat, typed_totals=True)
    assert (typed.first()["visits"], typed.first()["transactions"]) == (None, 3)
    assert "pageviews" not in typed.columns
    assert dict(typed.dtypes)["transactions"] == "int"


def test_json_dialect(raw):
    row = visit_kpi(raw({"hits": '[{"type":"A","isInteraction":true}]'}), dialect="json").first()
    assert (row["hitType"], row["isInteraction"]) == ("A", "true")


def test_plan(raw, spark, tmp_path, capsys):
    raw({}).write.parquet(f"{tmp_path}/raw")
    visits = spark.read.parquet(f"{tmp_path}/raw")
    visit_kpi(visits).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan
    assert plan.count("ArrowEvalPython") == 1 and plan.count("from_json") == 1
    assert "IsNotNull(fullVisitorId), IsNotNull(visitId)" in plan
    schema = plan[plan.index("ReadSchema"):]
    assert "device" not in schema and "geoNetwork" not in schema

    visit_kpi(visits).select("channelGrouping").explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "hits" not in plan and "totals" not in plan
