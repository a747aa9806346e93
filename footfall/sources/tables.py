"""Catalog tables."""

from pyspark.sql import DataFrame, SparkSession

from footfall.sources.files import export_parquet


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_table(df: DataFrame, name: str) -> None:
    """Create or replace a managed table; ``df`` must not read that same table."""
    df.write.mode("overwrite").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Add rows to a managed table; columns go by name, and those that ``df`` lacks are NULL.

    A column that the table lacks raises an error.
    """
    spark = df.sparkSession
    wanted = spark.table(name).limit(0).unionByName(df, allowMissingColumns=True)
    extra = [column for column in wanted.columns if column not in spark.table(name).columns]
    if extra:
        raise ValueError(f"{name} has no columns {', '.join(extra)}")
    wanted.write.mode("append").saveAsTable(name)


def export_table(spark: SparkSession, name: str, path: str, single_file: bool = False) -> None:
    """Export a table to Parquet; see :func:`export_parquet` for ``single_file``."""
    export_parquet(spark.table(name), path, single_file)
