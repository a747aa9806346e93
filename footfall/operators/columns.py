"""Projections driven by the schema of the input."""

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.contract import PLACEHOLDER
from footfall.functions.text import null_if_placeholder


def quoted(name: str) -> str:
    """A column's exact name as text for ``select``, also when it holds dots."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop those of the columns that exist."""
    return df.drop(*names)


def keep_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep those of the columns that exist (case-sensitive), in the order of ``names``."""
    present = set(df.columns)
    return df.select([quoted(name) for name in names if name in present])


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    present = df.columns
    missing = [name for name in names if name not in present]
    if missing:
        raise AnalysisException(f"missing column(s) {missing}; the input has {present}")


def map_string_columns(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Apply ``change`` to every string column in one projection; others pass through."""
    return df.select([
        change(column(name)).alias(name) if dtype == "string" else quoted(name)
        for name, dtype in df.dtypes
    ])


def nullify_placeholders(df: DataFrame, placeholder: str = PLACEHOLDER) -> DataFrame:
    """NULL out every string value that contains the placeholder text."""
    return map_string_columns(df, lambda value: null_if_placeholder(value, placeholder))
