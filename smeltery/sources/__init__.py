from .inventory import exact, inventoried, landed_files, read_inventory
from .periods import list_files, list_periods, period_path, read_period, read_periods
from .reference_csv import read_csv_strings
from .tables import count_rows, declare_sources, read_table

__all__ = [
    "count_rows",
    "declare_sources",
    "exact",
    "inventoried",
    "landed_files",
    "list_files",
    "list_periods",
    "period_path",
    "read_csv_strings",
    "read_inventory",
    "read_period",
    "read_periods",
    "read_table",
]
