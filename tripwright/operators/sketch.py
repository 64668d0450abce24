"""A Bloom filter of a batch's keys, put to a table before an anti-join with it.

Spark plans no run-time filter for anti-joins: all keys of the table's side are
shuffled, though the batch can only meet few of them.  The filter is made by the
batch's tasks, merged as words of bits, and sent to where the table is read; it lets
every key of the batch through, and of the others about one in a hundred.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 10
HASHES = 4
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28         # 32 MB at most


def bits_for(rows: int) -> int | None:
    """Bits of a filter for so many keys, a power of two; None if they are too
    many for one that is worth sending."""
    n = LEAST_BITS
    while n < BITS_PER_KEY * rows:
        n *= 2
    return n if n <= MOST_BITS else None


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    """``HASHES`` bit numbers of each 64-bit hash, by double hashing."""
    h = h.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    k = np.arange(HASHES, dtype=np.uint64)
    return ((h[:, None] + k * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def key_filter(rows: DataFrame, keys: list[str], bits: int) -> np.ndarray:
    """The filter's words for the keys of ``rows``; at most ``bits / 64`` reach
    the driver."""
    def words(batches):
        own = np.zeros(bits // 64, np.uint64)
        for b in batches:
            at = _places(b.column(0).to_numpy(), bits).reshape(-1)
            np.bitwise_or.at(own, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        some = np.nonzero(own)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(own[some].view(np.int64))], ["at", "word"])

    got = (rows.select(F.xxhash64(*keys)).mapInArrow(words, "at long, word long")
           .groupBy("at").agg(F.bit_or("word").alias("word")).toArrow())
    out = np.zeros(bits // 64, np.uint64)
    out[got.column("at").to_numpy()] = got.column("word").to_numpy().view(np.uint64)
    return out


def may_match(table: DataFrame, keys: list[str], rows: DataFrame, n: int) -> DataFrame:
    """The ``keys`` of ``table`` without most of those that none of the ``n`` rows
    of ``rows`` has; all of them if the rows are too many for a filter."""
    bits = bits_for(n)
    if bits is None:
        return table.select(*keys)
    words = table.sparkSession.sparkContext.broadcast(key_filter(rows, keys, bits))      # bounded above

    def look(batches):
        for b in batches:
            at = _places(b.column(b.num_columns - 1).to_numpy(), bits)
            found = (words.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).all(axis=1)
            yield b.select(range(b.num_columns - 1)).filter(pa.array(found))

    own = table.select(*keys)
    return own.withColumn("__h", F.xxhash64(*keys)).mapInArrow(look, own.schema)
