from footfall.operators.chunks import split_csv
from footfall.operators.columns import (
    drop_columns, keep_columns, map_string_columns, nullify_placeholders, require_columns,
)
from footfall.operators.profile import (
    column_profile, null_counts, profile_metrics, row_count, rows_where_null, table_counts,
)
from footfall.operators.rows import drop_rows_missing, union_lots

__all__ = [
    "column_profile",
    "drop_columns",
    "drop_rows_missing",
    "keep_columns",
    "map_string_columns",
    "null_counts",
    "nullify_placeholders",
    "profile_metrics",
    "require_columns",
    "row_count",
    "rows_where_null",
    "split_csv",
    "table_counts",
    "union_lots",
]
