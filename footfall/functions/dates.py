from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(value: Column) -> Column:
    """Date from a ``yyyyMMdd`` text or number; NULL when it is no such day."""
    return F.try_to_date(value.cast("string"), "yyyyMMdd")


def date_parts(day: Column) -> list[Column]:
    """``year``, ``month``, ``day`` and the full English ``weekday`` name of a date."""
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("weekday"),
    ]
