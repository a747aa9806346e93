"""Raw visit exports: CSV in, cleaned Parquet out."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.json_text import normalize_json_list, normalize_json_map
from footfall.operators.columns import nullify_placeholders, require_columns
from footfall.sources.files import (
    has_large_files, read_csv, read_csv_splits, read_csv_wide, write_parquet,
)


def clean_raw(df: DataFrame) -> DataFrame:
    """Canonical JSON in ``device`` and ``customDimensions``, then placeholders to NULL.

    The order matters: a placeholder anywhere in a JSON text wipes the whole text.
    """
    require_columns(df, ["device", "customDimensions"])
    normalized = df.withColumns({
        "device": normalize_json_map(F.col("device")),
        "customDimensions": normalize_json_list(F.col("customDimensions")),
    })
    return nullify_placeholders(normalized)


def ingest_csv(
    spark: SparkSession,
    source: str,
    target: str,
    wide: bool = False,
    partitions: int | None = None,
    splits: bool | None = None,
) -> None:
    """CSV file or folder to a cleaned Parquet folder.

    With ``splits`` files are read in splits by many tasks, with no shuffle; by default where the
    largest has several splits, as that reads the text three times.  Else each file is one task.
    ``partitions`` deals the rows to so many tasks before cleaning, which then write as many files.
    """
    if splits is None:
        splits = not partitions and has_large_files(spark, source)
    raw = (read_csv_splits if splits else read_csv_wide if wide else read_csv)(spark, source)
    if partitions:
        raw = raw.repartition(partitions)
    write_parquet(clean_raw(raw), target)
