from footfall.sources.files import (
    accumulate_parquet, export_parquet, read_accumulated, read_csv, read_csv_by_header,
    read_csv_splits, read_csv_wide, read_parquet, sized, write_csv, write_parquet,
)
from footfall.sources.lots import read_lot
from footfall.sources.tables import append_table, export_table, read_table, write_table

__all__ = [
    "accumulate_parquet",
    "append_table",
    "export_parquet",
    "export_table",
    "read_accumulated",
    "read_csv",
    "read_csv_by_header",
    "read_csv_splits",
    "read_csv_wide",
    "read_lot",
    "read_parquet",
    "read_table",
    "sized",
    "write_csv",
    "write_parquet",
    "write_table",
]
