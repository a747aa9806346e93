import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from footfall.llm.decontaminate import contamination
from footfall.llm.neardup import near_duplicates
from footfall.llm.secrets import base_spans

pytest.importorskip("public_tokenizers")
SF_DIR = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert set(kept[name]) <= set(before)
        before = kept[name]
    assert len(kept["language_id"]) >= 199
    again = near_duplicates(docs)
    assert again.where("NOT kept").count() == 0
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert contamination(docs, bench).where("n_hit > 0").count() == 0
    assert docs.where(F.size(base_spans(F.col("text"))) > 0).count() == 0
    pieces = pipeline.pack(spark, docs, SF_DIR)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(before)
    assert pieces.agg(F.sum("length")).first()[0] == pieces.select("doc_id", "doc_tokens").distinct().agg(
        F.sum("doc_tokens")).first()[0]


def test_run_equals_the_stages(spark):
    rows = pipeline.run(spark, SF_DIR)
    assert rows.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    full = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert full.where("n > 2048").count() == 0 and rows.count() > 150


def test_odd_rows_pass_every_stage(spark, tmp_path):
    random.seed(1)
    line = " ".join(random.choices(["the", "and", "of", "with", "this", "house", "river"], k=60))
    rows = [(i, f"{line} number{i} " + " ".join(f"w{random.randrange(900)}" for _ in range(80)), "en", "s", 9)
            for i in range(40)]
    rows += [(100, None, "en", "s", 0), (101, "", None, None, None), (102, "12 34", "en", "s", 5),
             (None, f"{line} with no id", "en", "s", 1), (0, *rows[0][1:]), (103, rows[0][1], "en", "t", 9),
             (104, "the river and the house " * 5000, "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, rows[5][1][-60:])], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    ids = {r.doc_id for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert ids == (set(range(40)) - {5}) | {None, 104}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_rows_that_share_an_id_or_have_none(spark):
    random.seed(2)
    one, two, three = (" ".join(f"{c}{random.randrange(900)}" for _ in range(60)) for c in "abc")
    rows = [(1, one), (1, two), (1, one), (2, one + " end"), (None, two), (None, three), (None, three),
            (5, ""), (5, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()
    want = [(1, one), (1, two), (None, three), (5, ""), (6, None)]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))
