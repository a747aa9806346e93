"""Text to number where bad text is NULL, also with ANSI mode on."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = "^-?[0-9]+$"
# Blanks or control characters around; maybe a sign; digits, of which those after a point
# do not count.
_SPELLED_OTHERWISE = (
    r"^[\s\p{Cntrl}]*(?<sign>[+-]?)(?:(?<whole>\d*)\.\d*|(?<digits>\d+))[\s\p{Cntrl}]*$"
)


def lenient_int(value: Column) -> Column:
    """Integer part of the number in a text ("2.5" is 2); NULL for bad text or overflow.

    Like a non-ANSI cast, a text with nothing before the point (".5") is 0.  Texts are
    matched first because a ``try_cast`` that fails builds an exception for every row.
    """
    respelled = F.regexp_replace(value, _SPELLED_OTHERWISE, "${sign}0${whole}${digits}")
    number = F.when(value.rlike(_DIGITS), value).when(value.rlike(_SPELLED_OTHERWISE), respelled)
    return number.try_cast("int")


def lenient_double(value: Column) -> Column:
    return value.try_cast("double")
