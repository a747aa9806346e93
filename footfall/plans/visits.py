"""The per-visit KPI table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.contract import (
    HIT_COLUMNS, IGNORED_COLUMNS, KEY_COLUMNS, KPI_COLUMNS, METRIC_TYPES, RAW_KPI_COLUMNS,
)
from footfall.functions.hits import first_hit
from footfall.functions.json_text import parse_totals
from footfall.functions.numbers import lenient_double, lenient_int
from footfall.operators.columns import (
    drop_columns, keep_columns, nullify_placeholders, require_columns,
)
from footfall.operators.rows import drop_rows_missing


def visit_kpi(
    df: DataFrame, dialect: str = "python_literal", typed_totals: bool = False
) -> DataFrame:
    """One typed row per raw visit that has both keys.

    Columns absent from the input are absent from the result, except that the keys and
    ``hits`` are required.  ``dialect`` says how ``hits`` is written (see ``first_hit``).
    With ``typed_totals`` the metrics may also come as a ``totals`` struct or as four
    plain columns; without it only a ``totals`` text gives metrics.
    """
    wanted = RAW_KPI_COLUMNS + (list(METRIC_TYPES) if typed_totals else [])
    visits = keep_columns(drop_columns(df, IGNORED_COLUMNS), wanted)
    require_columns(visits, [*KEY_COLUMNS, "hits"])
    # A raw NULL key stays NULL below; said on the raw column it reaches the Parquet scan.
    visits = drop_rows_missing(visits, KEY_COLUMNS)
    visits = drop_rows_missing(nullify_placeholders(visits), KEY_COLUMNS)

    visits = _with_metrics(visits, typed_totals)
    visits = visits.withColumn("hit", first_hit(F.col("hits"), dialect))
    visits = visits.withColumns({name: F.col(f"hit.{name}") for name in HIT_COLUMNS})
    return keep_columns(visits, KPI_COLUMNS)


def _with_metrics(visits: DataFrame, typed_totals: bool) -> DataFrame:
    types = {field.name: field.dataType for field in visits.schema}
    totals = types.get("totals")
    if isinstance(totals, T.StringType):
        visits = visits.withColumn("totals", parse_totals(F.col("totals")))
        totals = visits.schema["totals"].dataType
    elif not typed_totals:
        return visits
    if isinstance(totals, T.StructType):
        sources = {f"totals.{field.name}": field for field in totals}
    else:
        sources = {field.name: field for field in visits.schema}
    return visits.withColumns({
        field.name: _metric(F.col(path), field.dataType, METRIC_TYPES[field.name])
        for path, field in sources.items() if field.name in METRIC_TYPES
    })


def _metric(value: Column, given: T.DataType, wanted: str) -> Column:
    if not isinstance(given, T.StringType):
        return value.try_cast(wanted)
    return lenient_int(value) if wanted == "int" else lenient_double(value)
