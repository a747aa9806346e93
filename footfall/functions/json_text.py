"""JSON held in text columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.contract import CUSTOM_DIMENSIONS_SCHEMA, DEVICE_SCHEMA, TOTALS_SCHEMA


def normalize_json_map(text: Column) -> Column:
    """Rewrite a JSON object as canonical text with string values; NULL if it is none."""
    return F.to_json(F.from_json(text, DEVICE_SCHEMA))


def normalize_json_list(text: Column) -> Column:
    """Same for a JSON array of objects; a bare object or bad text gives NULL."""
    return F.to_json(F.from_json(text, CUSTOM_DIMENSIONS_SCHEMA))


def parse_totals(text: Column) -> Column:
    """Struct of the four totals as text.

    Text that does not begin with a JSON object gives a struct of NULLs; what follows the
    object's closing bracket is ignored, as the engine's JSON reader does.
    """
    return F.from_json(text, TOTALS_SCHEMA)
