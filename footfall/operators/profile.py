"""Row and NULL counts, each in a single pass over the data."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.columns import column
from footfall.operators.rows import union_lots

ROWS = "rows"


def rows_where_null(df: DataFrame, name: str) -> DataFrame:
    return df.filter(column(name).isNull())


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows, as column ``rows``."""
    return df.agg(F.count(F.lit(1)).alias(ROWS))


def null_counts(df: DataFrame) -> list[Column]:
    """One NULL-counting aggregate per column, named like the column."""
    return [F.count_if(column(name).isNull()).alias(name) for name in df.columns]


def profile_metrics(df: DataFrame) -> list[Column]:
    """Aggregates ``n`` (rows) and ``n_0, n_1, ...`` (NULLs by column position).

    Positional names cannot clash with column names, so they suit ``df.observe``.
    """
    nulls = [count.alias(f"n_{i}") for i, count in enumerate(null_counts(df))]
    return [F.count(F.lit(1)).alias("n"), *nulls]


def column_profile(df: DataFrame) -> DataFrame:
    """``column_name, rows, nulls``: one row per column, from one aggregation."""
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.col("n").alias(ROWS),
                 F.col(f"n_{i}").alias("nulls"))
        for i, name in enumerate(df.columns)
    ]
    return df.agg(*profile_metrics(df)).select(F.inline(F.array(*entries)))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, rows`` for several tables as one DataFrame, counted in one job."""
    counts = [
        row_count(df).select(F.lit(name).alias("table_name"), ROWS)
        for name, df in tables.items()
    ]
    return union_lots(*counts)
