"""The training-data pipeline: five stages over ``documents``, each written before the next."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import decontaminate, language, neardup, packing, secrets
from footfall.llm.queries import table, tokenizer_file
from footfall.scratch import write_aside

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: SQL cannot express the fitted language model nor the packing.
ORACLE_SQL = None


def _apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """The documents with all columns but those a stage uses under names that no operator has, and what
    gives all columns their own names back."""
    names = {c: c if c in used else f"_own{i}" for i, c in enumerate(docs.columns)}
    return (docs.select(*(F.col(f"`{c}`").alias(name) for c, name in names.items())),
            [F.col(name).alias(c) for c, name in names.items()])


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is undetermined or far from all that were learned."""
    rows, own = _apart(docs, "doc_id", "text", "lang")
    return language.identify(rows, language.learn(rows)).where("NOT rejected").select(*own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest id of each group, of one id that with the smallest hash of
    its text; rows without an id come last.

    Groups are of rows, so texts that share an id but are no near copies all stay.  Of rows with
    the same id and a text without words one stays.
    """
    rows, own = _apart(docs, "doc_id", "text")
    rows = write_aside(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = neardup.near_duplicates(rows, key="_row").select("_row", "n_shingles", "component_id")
    wordless = (F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text").alias("hash"), "_row")
    kept = (
        rows.select("_row", place.alias("place"), "doc_id").join(found, "_row")
        .groupBy(F.when(wordless, F.col("doc_id")).alias("id"),
                 F.when(~wordless, F.col("component_id")).alias("component"),
                 F.when(wordless, F.col("place.hash")).alias("hash"))
        .agg(F.min("place").alias("least")).select(F.col("least._row").alias("_row"))
    )
    return rows.join(kept, "_row", "left_semi").select(*own)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    rows, own = _apart(docs, "text")
    found = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select(*own)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark; ``n_chars`` follows the text."""
    rows, own = _apart(docs, "text", "n_chars")
    found = secrets.scan_secrets(rows, secrets.labelled_samples(rows))
    clean = found.withColumn("text", secrets.redacted(F.col("text"), F.col("spans")))
    return clean.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(*own)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their token ids."""
    return packing.pack_documents(docs, tokenizer_file(), keep=["doc_id"])


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_aside(stage(spark, docs, sf_dir), name)
    return docs
