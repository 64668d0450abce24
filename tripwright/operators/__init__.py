"""DataFrame-in / DataFrame-out operators of the warehouse."""

from .dims import (distinct_members, event_time_members, event_time_rows,
                   fill_event_time, new_members, upsert_dim)
from .facts import build_delta, group_trips, insert_if_absent
from .ids import dense_ids
from .spatial import points_in_boxes

__all__ = [
    "distinct_members", "event_time_members", "event_time_rows", "fill_event_time",
    "new_members", "upsert_dim", "build_delta", "group_trips", "insert_if_absent",
    "dense_ids", "points_in_boxes",
]
