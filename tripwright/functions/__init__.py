"""Column-level helpers: every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from .geo import box, box_contains, case_lower, case_upper, coordinate, point_xy
from .keys import event_id, event_id_hex
from .timeparts import (day_start, event_time_parts, format_day, format_timestamp,
                        iso_weekday)

__all__ = [
    "box", "box_contains", "case_lower", "case_upper", "coordinate", "point_xy",
    "event_id", "event_id_hex", "day_start", "event_time_parts", "format_day",
    "format_timestamp", "iso_weekday",
]
