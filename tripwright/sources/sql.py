"""SQL access: warehouse tables in a session catalog and parameter-bound reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import MONTHLY, TABLES, TablePaths, read_table


def register_views(spark: SparkSession, paths: TablePaths, prefix: str = "") -> list[str]:
    """Expose every table as a temporary view (``<prefix><table>``)."""
    names = []
    for table in TABLES:
        name = f"{prefix}{table}"
        read_table(spark, paths, table).createOrReplaceTempView(name)
        names.append(name)
    return names


def register_catalog(spark: SparkSession, paths: TablePaths) -> None:
    """Create databases ``trips_stage``, ``trips`` and ``logs`` holding external
    parquet tables over the written folders, so SQL written against
    ``trips.fact_trips`` etc. runs unchanged in ``spark.sql``."""
    from ..session import path_exists
    for table, (db, schema) in TABLES.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
        full = f"{db}.{table}"
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        path = paths.path(table)
        if not path_exists(spark, path):
            continue
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        part = " PARTITIONED BY (year, month)" if table in MONTHLY else ""
        spark.sql(f"CREATE TABLE {full} ({cols}) USING parquet{part} LOCATION '{path}'")
        if table in MONTHLY:
            spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")


def run_query(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """Parameter-bound SQL (``:name`` markers), returned as a DataFrame."""
    return spark.sql(sql, args=args or None)
