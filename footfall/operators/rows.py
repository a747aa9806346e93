from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.columns import column


def drop_rows_missing(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows where any of the keys is NULL (or NaN); empty strings stay.

    The same rows as ``dropna(subset=keys)``, but said in a way that file scans can use.
    """
    types = dict(df.dtypes)

    def present(key: str) -> Column:
        known = column(key).isNotNull()
        return known & ~F.isnan(column(key)) if types[key] in ("float", "double") else known

    return df.filter(reduce(Column.__and__, map(present, keys)))


def union_lots(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all lots, matched by column name; a missing column is an error."""
    return reduce(DataFrame.unionByName, others, first)
