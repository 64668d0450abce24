"""Dense surrogate keys without a single-partition window.

Rows are range-partitioned on the key, sorted inside partitions and pinned with
a reliable checkpoint (written to the shared ``spark.checkpoint.dir``: it
survives executor loss and is never recomputed differently).  Then

    id = start + (rows in earlier partitions) + (position in partition) + 1

The rows per partition are one number per partition - bounded by the number of
partitions asked for - and go through the driver into a small joined table.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import default_parallelism, ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | row position


def dense_ids(df: DataFrame, order_cols: list[str], id_col: str, start: int = 0,
              num_partitions: int | None = None, id_type: str = "int") -> DataFrame:
    """Append ``id_col`` = start+1, start+2, ... in ``order_cols`` order
    (rows must be unique on ``order_cols`` for the order to be total)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols = [c for c in df.columns if c != id_col]
    n = num_partitions or max(1, default_parallelism(spark))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    tagged = ranged.checkpoint(eager=True).withColumn("_mid", F.monotonically_increasing_id())
    pid = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1)
    counts = sorted(tuple(r) for r in tagged.groupBy(pid.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = accumulate((n for _, n in counts), initial=start)
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "_pid long, _off long")
    out = (tagged.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid")   # a row per partition
           .withColumn(id_col, (F.col("_off") + pos + F.lit(1)).cast(id_type)))
    return out.select(id_col, *cols)
