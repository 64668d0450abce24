"""Event hash id of a trip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator placed between the hashed text fields.
EVENT_ID_SEPARATOR = "-"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_id(region="region", datasource="datasource", origin="origin_coord",
             destination="destination_coord") -> Column:
    """16-byte MD5 of ``region-datasource-origin-destination`` (raw text).

    ``concat_ws('')`` skips NULL inputs like the PostgreSQL ``concat`` it
    mirrors; ``concat`` would turn the whole key NULL.  The timestamp is not
    hashed: the fact key is (event_timestamp, event_id).
    """
    sep = F.lit(EVENT_ID_SEPARATOR)
    text = F.concat_ws("", _col(region), sep, _col(datasource), sep,
                       _col(origin), sep, _col(destination))
    return F.unhex(F.md5(text))


def event_id_hex(c="event_id") -> Column:
    """Lower-case 32-character hex text of a binary id (for comparisons)."""
    return F.lower(F.hex(_col(c)))
