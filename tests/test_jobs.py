import jobs
from footfall.sources import read_parquet, write_csv


def test_the_whole_chain(spark, raw, tmp_path, capsys):
    def job(*args):
        jobs.run(spark, jobs.arguments().parse_args([str(arg) for arg in args]))

    rows = [{"visitId": str(i), "hits": "[{'type': 'PAGE',\n'page': {'pagePath': '/%d'}}]" % i}
            for i in range(25)]
    write_csv(raw(*rows).coalesce(1), f"{tmp_path}/csv")
    job("split-csv", tmp_path / "csv", tmp_path / "parts", "--rows", 10)
    job("ingest", tmp_path / "parts", tmp_path / "clean", "--wide")
    assert read_parquet(spark, f"{tmp_path}/clean").columns == raw({}).columns
    job("kpi", tmp_path / "clean", tmp_path / "kpi1")
    job("kpi", tmp_path / "clean", tmp_path / "kpi2", "--checkpoint", tmp_path / "ck")
    job("monitor", tmp_path / "clean", "--checkpoint", tmp_path / "ck2", "--events",
        tmp_path / "events")
    job("load-lots", tmp_path / "kpi1", tmp_path / "kpi2")
    job("star", "--export-to", tmp_path / "star")
    out = capsys.readouterr().out
    assert "|hechos_visitas     |50  |" in out and "|dim_pagina         |25  |" in out
    assert read_parquet(spark, f"{tmp_path}/star/hechos_visitas").count() == 50
