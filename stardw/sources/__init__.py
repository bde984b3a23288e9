from .contracts import conform, with_missing_columns
from .readers import date_series, projected, read_csv, read_jdbc, read_table, rows
from .writers import (append_periods, create_or_replace, drop_periods, full_load,
                      merge_into_partitions)

__all__ = [
    "append_periods", "conform", "create_or_replace", "date_series", "drop_periods",
    "full_load", "merge_into_partitions", "projected", "read_csv", "read_jdbc", "read_table", "rows",
    "with_missing_columns",
]
