"""Session construction and the shared working folder.

On a cluster the working folder comes from ``spark.checkpoint.dir`` (a shared
file system every executor can reach).  Only when the session has none - unit
tests, a laptop - do we create one of our own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package expects.  Shuffle partition counts are
# left to the caller: AQE coalesces small partitions and splits skewed ones
# at run time, so the static number is an upper bound, not a tuning knob.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
    "spark.ui.enabled": "false",
    # Remove reliable-checkpoint files once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "tripwright",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage "
                "(every executor must reach it)")
        # Local mode / tests only: one machine, so a local folder is shared.
        configured = tempfile.mkdtemp(prefix="tripwright-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_root(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(parts) if parts else uuid.uuid4().hex
    return f"{base}/tripwright/{leaf}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    if not path_exists(spark, path):
        return []
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(hpath)]


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete a folder we created (staging), via its file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hpath, True)


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files below a folder and their bytes, from the file system's own summary;
    zeros for one that isn't there."""
    if not path_exists(spark, path):
        return 0, 0
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(hpath)
    return found.getFileCount(), found.getLength()


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder we created, via its file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(hpath, jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not rename {path} to {to}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark that a step of a protocol is done."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hpath, True).close()


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # pragma: no cover - Connect sessions
        return int(os.environ.get("BENCH_CPUS", "8"))
