"""One query per operator, with production parameters, over the whole of its tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    alignment, bpe, decontaminate, language, lm, negatives, neardup, packing, quality, secrets, substrings, url_filter, vectors,
)
from footfall.llm.exchange import crc_rest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: The rules of the URL filter.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Sites whose pages make the list of blocked URLs.
LISTED_SITES = ("adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
TOKENIZER = "word_bpe_49k.json"
METADATA = ["source", "lang", "n_chars"]


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = TOKENIZER) -> str:
    """A public vocabulary that every machine holds with its Python packages."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _id_list(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)


@query("op1_url_filter")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, else blocked if the canonical URL is listed: one of a page on a listed site."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    sites = "|".join(LISTED_SITES)
    listed = pages.where(url_filter.url_host(F.col("url")).rlike(rf"(^|\.)({sites})\."))
    return url_filter.url_verdicts(pages, listed, RULES).select(
        "page_id", "host", "path", "rule", "verdict", "listed")


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan_secrets(docs, secrets.labelled_samples(docs))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"), count(3).alias("n_random"),
    )


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        _id_list(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document without an id is not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_rest("doc_id", 4) == 2, F.lit(False))
    model = language.learn(docs.where(~held_out))
    return language.identify(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(
        table(spark, sf_dir, "documents"), tokenizer_file(), keep=["doc_id"])
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good document has quality 1 and is not toxic."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good"))
    model = quality.learn(docs, labels, METADATA)
    return quality.score_quality(docs, model, METADATA, keep=["doc_id"]).withColumn(
        "keep", F.col("score") >= 0.5)


@query("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.drop_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_minhash_dedup")
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_lm_score")
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


@query("op5_embedding_dedup")
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_duplicates(table(spark, sf_dir, "embeddings"))


@query("op11_hard_negatives")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh vector is labelled wrongly on purpose, so that there are near rows of other labels."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align_documents(
        docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


@query("op13_bpe")
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode_documents(docs, tokenizer_file())
    return bpe.decode_documents(ids, tokenizer_file()).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
