from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.contract import PLACEHOLDER


def null_if_placeholder(value: Column, placeholder: str = PLACEHOLDER) -> Column:
    """NULL when the text contains the placeholder anywhere (case-sensitive)."""
    return F.when(value.contains(placeholder), None).otherwise(value)
