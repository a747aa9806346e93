from footfall.functions.dates import date_parts, parse_day
from footfall.functions.hits import first_hit, with_first_hit
from footfall.functions.json_text import normalize_json_list, normalize_json_map, parse_totals
from footfall.functions.numbers import lenient_double, lenient_int
from footfall.functions.text import null_if_placeholder

__all__ = [
    "date_parts",
    "first_hit",
    "lenient_double",
    "lenient_int",
    "normalize_json_list",
    "normalize_json_map",
    "null_if_placeholder",
    "parse_day",
    "parse_totals",
    "with_first_hit",
]
