from footfall.plans.catalog import load_lots
from footfall.plans.raw import clean_raw, ingest_csv
from footfall.plans.star import (
    StarTables, build_star, channel_dimension, date_dimension, extend_star, page_dimension, visit_facts,
    visitor_dimension,
)
from footfall.plans.visits import visit_kpi

__all__ = [
    "StarTables",
    "build_star",
    "channel_dimension",
    "clean_raw",
    "date_dimension",
    "extend_star",
    "ingest_csv",
    "load_lots",
    "page_dimension",
    "visit_facts",
    "visit_kpi",
    "visitor_dimension",
]
