"""Structured Streaming variants of the load: continuous file ingest,
re-delivery de-duplication and event-time daily counts."""

from .ingest import (daily_counts, event_time, ingest_stream, read_daily_counts,
                     trips_file_stream, write_daily_counts, write_deduplicated)

__all__ = ["daily_counts", "event_time", "ingest_stream", "read_daily_counts",
           "trips_file_stream", "write_daily_counts", "write_deduplicated"]
