"""Trip files: header-skipping CSV with a declared schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import CORRUPT, TRIPS
from .csv_records import read_records

# The timestamp text format of the trip files (up to six digits
# of a second's fraction are optional) and their quoting: a quote inside a
# quoted field is doubled, a backslash is an ordinary character.
TRIPS_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
DIALECT = {"header": True, "quote": '"', "escape": '"', "timestampNTZFormat": TRIPS_TIMESTAMP_FORMAT}


def read_trips(spark: SparkSession, paths: str | Iterable[str], strict: bool = True,
               multiline: bool = False) -> DataFrame:
    """Read trip CSV files (any Hadoop-FS path, glob or list of paths).

    The five columns are positional and typed up front - no inference.  With
    ``strict`` a malformed row (wrong column count, bad timestamp) aborts the
    read (FAILFAST), as the bulk load it replaces did.  Otherwise such a row
    comes with its original text in ``_corrupt_record``, for the quarantine.
    ``multiline`` allows line breaks inside quoted fields (``csv_records``); a
    large file is still read by many tasks.
    """
    if isinstance(paths, str):
        paths = [paths]
    schema = TRIPS if strict else StructType([*TRIPS.fields, StructField(CORRUPT, StringType())])
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if multiline:
        records = read_records(spark, list(paths)).where("start > 0 or no > 0")      # without the header
        return records.select(F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {
            k: str(v) for k, v in (DIALECT | mode).items() if k != "header"}).alias("r")).select("r.*")
    return spark.read.schema(schema).options(**DIALECT, **mode).option("enforceSchema", True).csv(list(paths))


def file_id_from_share_uri(uri: str) -> str:
    """File id of a share link ``.../d/<id>/view`` - the second-last segment."""
    return uri.split("/")[-2]


def share_file_id(uri) -> Column:
    """The same of a column of links; NULL for one without two segments."""
    return F.try_element_at(F.split(uri, "/"), F.lit(-2))
