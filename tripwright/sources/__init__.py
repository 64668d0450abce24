"""Sources and sinks: trip files, the driver-data adapter, parquet tables."""

from .adapter import stage_from_events, stage_from_sf
from .csv_trips import read_trips
from .tables import (TablePaths, append_log_rows, month_predicate, read_table,
                     write_monthly, write_stage)

__all__ = [
    "stage_from_events", "stage_from_sf", "read_trips", "TablePaths",
    "append_log_rows", "month_predicate", "read_table", "write_monthly",
    "write_stage",
]
