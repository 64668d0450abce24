"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, work_root


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def worker_path(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver found it
    (a cluster that installs or ships the package needs nothing of this)."""
    import os
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return work_root(spark, "llm", f"{name}-{uuid.uuid4().hex}")


_LEFT: dict[str, SparkSession] = {}      # tables written by save() and not dropped yet


@atexit.register
def _clean_up() -> None:
    """Results are read until Python exits; what they read goes then."""
    for path, spark in list(_LEFT.items()):
        with contextlib.suppress(Exception):     # the session may be gone already
            delete_path(spark, path)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back: cuts the lineage, so a
    lost executor costs a re-read and not a recomputation.  The table goes with
    :func:`drop`, or when Python exits."""
    spark = df.sparkSession
    path = scratch(spark, name)
    _LEFT[path] = spark
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def drop(*saved: DataFrame) -> None:
    """Remove tables written by :func:`save` that nothing reads any more."""
    for df in saved:
        path = getattr(df, "_saved_at", None)
        if path:
            delete_path(df.sparkSession, path)
            _LEFT.pop(path, None)


def marks(*cols) -> list:
    """Two 64-bit hashes that identify a row by the given columns; a null is a
    value of its own.  Rows equal in all of them are one row to an operator."""
    full = [x for c in cols for x in (c, c.isNull())]
    return [F.xxhash64(F.lit(i), *full) for i in (1, 2)]


def connected(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as long pairs ``(u, v)``:
    ``(node, root)`` with the smallest node of each component as root (every
    node that has an edge; roots map to themselves).

    Alternating large-star / small-star: each round is two aggregations and two
    equi-joins on the remaining edges, written to shared storage.  No node's
    neighbours are ever gathered in one place; a hub only splits over tasks.
    """
    cur = save(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(cur)
    while True:
        # Large star: every neighbour greater than u links to u's smallest one.
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = (both.join(low, both.u == low.c).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        # Small star: every smaller neighbour, and u, link to u's smallest one.
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        small = (large.join(low, large.u == low.c)
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v"))
                 .union(low.select("c", "m")).distinct())
        nxt = save(small, "edges")
        seen = _mark(nxt)
        drop(cur)
        cur = nxt
        if seen == mark:
            break
        mark = seen
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]
