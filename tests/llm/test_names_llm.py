"""Columns of the caller whose names clash with results or with names used inside."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from footfall.llm import (
    alignment, bpe, decontaminate, language, lm, neardup, negatives, packing, quality, secrets, substrings,
    url_filter, vectors,
)

public = pytest.importorskip("public_tokenizers")
SF_DIR = "/root/testdata/sf0.001"
NAMES = ["Spans", "items", "ITEMS", "score", "Lang_Pred", "_row", "_text", "_key", "_k0", "_k1", "a.b", "n_words", "Kept_Text",
         "ids", "Decoded", "chunk", "_place", "component", "post", "start", "_own0", "host", "Verdict", "_base", "data",
         "n_a", "_which", "level", "rank", "key"]
RESULTS = {
    "url_filter": ["host", "path", "rule", "listed", "verdict"],
    "substrings": ["n_words", "n_removed", "kept_text"], "secrets": ["spans"],
    "decontaminate": ["n_words", "n_hit", "items", "hit_from", "hit_to"],
    "language": ["lang_pred", "score", "rejected"],
    "packing": ["start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
    "quality": ["score", "text_score", "meta_score"],
    "alignment": ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "bpe": ["n_tokens", "ids"],
}


def named(df, some):
    """With the clashing columns, whose values are their names; of names that differ in case only one."""
    return df.select("*", *(F.lit(name).alias(name) for name in some))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 60")


OPERATORS = {
    "url_filter": lambda d: url_filter.url_verdicts(d.withColumnRenamed("text", "url"), d.selectExpr("text AS url"),
                                                    [("block", "net", "/")]),
    "substrings": substrings.drop_repeats,
    "secrets": lambda d: secrets.scan_secrets(d, secrets.labelled_samples(d)),
    "decontaminate": lambda d: decontaminate.contamination(d, d.limit(1).selectExpr("doc_id AS item_id", "text")),
    "language": lambda d: language.identify(d, language.learn(d)),
    "packing": lambda d: packing.pack_documents(d, public.path("word_bpe_49k.json")),
    "quality": lambda d: quality.score_quality(d, quality.learn(
        d, d.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS good"), ["source"]), ["source"]),
    "alignment": lambda d: alignment.align_documents(
        d, public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")),
    "bpe": lambda d: bpe.encode_documents(d, public.path("word_bpe_49k.json")),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_operators_keep_what_does_not_clash(docs, name):
    some = [n for n in NAMES if n != "ITEMS"]
    out = OPERATORS[name](named(docs, some))
    kept = [n for n in some if n.lower() not in RESULTS[name]]
    assert out.columns[-len(RESULTS[name]):] == RESULTS[name]
    assert [c for c in out.columns if c in some and c not in RESULTS[name]] == kept
    assert out.where(" OR ".join(f"`{n}` IS DISTINCT FROM '{n}'" for n in kept)).count() == 0 and out.count() >= 60


OWN = {"lm": lambda d: lm.score_documents(d), "neardup": lambda d: neardup.near_duplicates(d)}


@pytest.mark.parametrize("name", list(OWN))
def test_operators_with_columns_of_their_own_ignore_others(docs, name):
    some = [n for n in NAMES if n != "ITEMS"]
    plain, odd = (sorted(map(repr, OWN[name](d).collect())) for d in (docs, named(docs, some)))
    assert plain == odd


def test_vector_operators_ignore_others(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").where("vec_id < 120")
    odd = named(rows, [n for n in NAMES if n != "ITEMS"])
    for run in (vectors.vector_duplicates, lambda d: negatives.mine_hard_negatives(d, F.col("vec_id") % 50 == 0)):
        assert sorted(map(repr, run(rows).collect())) == sorted(map(repr, run(odd).collect()))


@pytest.mark.parametrize("stage", [name for name, _ in pipeline.STAGES])
def test_stages_return_the_callers_columns(spark, docs, stage):
    some = [n for n in NAMES if n != "ITEMS"]
    rows = named(docs, some)
    out = dict(pipeline.STAGES)[stage](spark, rows, SF_DIR)
    if stage == "packing":
        assert out.columns == ["doc_id", *RESULTS["packing"]] and out.count() >= 50
    else:
        assert out.columns == rows.columns
        assert out.where(" OR ".join(f"`{n}` IS DISTINCT FROM '{n}'" for n in some)).count() == 0
        assert 20 <= out.count() <= 60
