"""Best-fit packing of token sequences, certified by lower bounds.

Texts are tokenized once; what is packed are the pieces' lengths.  Pieces are
dealt to groups of bounded size, each packed by best-fit decreasing.  A group
whose bins are as few as its volume needs is certified and gives back only its
emptiest bin, a group with a gap gives back every bin with room.  What was given
back is held against dual-feasible-function bounds: if its bins are as few as
these allow, it stays; else it is dealt anew (pieces of different groups meet)
and packed again, until it fits one group or a round hardly saves a bin.
"""

from __future__ import annotations

import zlib
from array import array
from functools import cache
from itertools import count as count_up

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, save

CAPACITY = 2048
END = 0                    # id closing each document
GROUP = 100_000            # pieces per group
LEAST_FALL = 0.001         # share of the bins given back that a round must save, or it is the last

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ---- tokens ---------------------------------------------------------------------

_CODERS: dict[tuple[str, bool], object] = {}


def coder(path: str, added: bool = False):
    """``text -> ids`` of a byte-level BPE vocabulary file (JSON of
    ``tokenizers``), kept by the worker.

    The file's vocabulary in id order is its merge order, so the faster of the
    public libraries for such vocabularies gives the same ids (tests compare
    them).  A text that it refuses - its splitting pattern gives up on runs of
    some 100,000 blanks - goes to ``tokenizers`` itself.  ``added``: a string of
    an added token in a text is that token, as in ``tokenizers`` at its default
    settings; else it is ordinary text.
    """
    if (path, added) not in _CODERS:
        import json

        import public_tokenizers
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if added and any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens are matched as they are written only")
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        encoding = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens=special if added else {})
        def fast(text: str) -> list[int]:
            return encoding.encode(text, allowed_special="all" if added else set(), disallowed_special=())

        @cache
        def slow():
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.encode_special_tokens = not added
            return t

        def encode(text: str) -> list[int]:
            try:
                return fast(text)
            except ValueError:
                return slow().encode(text, add_special_tokens=False).ids

        _CODERS[path, added] = encode
    return _CODERS[path, added]


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in such a file:
    itself if it is visible Latin-1, else the next from U+0100 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: only the first may be
    shorter than ``capacity``."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, with_ids: bool = False, added: bool = False) -> DataFrame:
    """The pieces of each document: its ids, then id 0, in one piece if it
    fits and else cut.  ``with_ids`` adds the ids themselves, ``added`` is that
    of :func:`coder`."""
    def run(batches):
        encode = coder(vocabulary, added)
        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = array("I", encode(text.as_py() or ""))
                ids.append(END)
                out += [(doc, i, start, length, zlib.crc32(ids[start:start + length]),
                         ids[start:start + length] if with_ids else None)
                        for i, (start, length) in enumerate(cut(len(ids), capacity))]
            cols = list(zip(*out, strict=True)) or [[]] * 6
            arrays = [pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=False)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, np.uint32).astype(np.int32) for x in cols[5]],
                                       pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, PIECES + (", ids array<int>" if with_ids else ""))


# ---- packing ---------------------------------------------------------------------

def least_bins_of(count: np.ndarray) -> int:
    """Lower bound on the bins for ``count[n]`` pieces of each length ``n`` up
    to the capacity: the best of the dual feasible functions that round lengths
    over ``capacity - t`` up to a whole bin and lengths under ``t`` down to
    nothing, for each ``t`` up to half a bin (0: plain volume), and of the one
    that counts lengths over half a bin."""
    capacity = len(count) - 1
    volume = np.concatenate([[0], np.cumsum(count * np.arange(capacity + 1))])   # of lengths < i
    number = np.concatenate([[0], np.cumsum(count)])
    t = np.arange(capacity // 2 + 1)
    large = number[-1] - number[capacity - t + 1]
    middle = volume[capacity - t + 1] - volume[t]
    bound = int(np.max(large - (-middle // capacity)))
    return max(bound, int(number[-1] - number[capacity // 2 + 1]))


def least_bins(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    return least_bins_of(np.bincount(lengths, minlength=capacity + 1).astype(np.int64))


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each length, and the bins' fill.
    Open bins are kept by free room; a bit mask finds the tightest that fits."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fill = 0, []
    at, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            b, room = len(fill), capacity
            fill.append(0)
        at[i], offset[i] = b, fill[b]
        fill[b] += n
        left = room - n
        if left:
            rooms[left].append(b)
            mask |= 1 << left
    return at, offset, np.array(fill, np.int64)


def settle(lengths: np.ndarray, last: bool, capacity: int = CAPACITY):
    """Pack one group: bin, offset and whether it stays, per piece.  Full bins
    stay; all but the emptiest do if their number is the bound by volume, which
    no exchange can lower."""
    at, offset, fill = best_fit(lengths, capacity)
    stays = fill == capacity
    if last:
        stays[:] = True
    elif len(fill) == -(-int(lengths.sum()) // capacity):
        stays[:] = True
        worst = int(np.argmin(fill))
        stays[worst] = fill[worst] == capacity
    return at, offset, stays[at]


def packer(turn: int, last: bool, capacity: int):
    """Packs the rows of one group; no two groups or turns share a sequence."""
    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("__row")
        number = table.column("__group")[0].as_py()
        at, offset, stays = settle(table.column("length").to_numpy(), last, capacity)
        sequence = (turn << 59) + (number << 24) + at
        return (table.drop_columns(["__group"])
                .append_column("sequence_id", pa.array(sequence))
                .append_column("offset", pa.array(offset))
                .append_column("__stays", pa.array(stays)))
    return packed


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that have a ``length`` from
    1 to ``capacity``; offsets of a sequence are gapless from 0."""
    columns = items.columns
    rest = save(items.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    schema = items.schema.simpleString()[7:-1].replace(":", " ")
    done, before = None, None
    for turn in count_up():
        n = rest.count()
        groups = max(1, -(-n // group))
        last = groups == 1

        dealt = rest.withColumn("__group", F.pmod(F.xxhash64("__row", F.lit(turn)), F.lit(groups)))
        placed = save(dealt.groupBy("__group").applyInArrow(
            packer(turn, last, capacity), f"{schema}, __row long, sequence_id long, offset long, __stays boolean"), "packed")
        drop(rest)
        if not last:
            # What was given back is certified too if its bins are as few as its bound.
            back = placed.where("not __stays")
            count = back.groupBy("length").agg(F.count("*").alias("n")).collect()    # at most `capacity` rows
            bins = back.select("sequence_id").distinct().count()
            number = np.zeros(capacity + 1, np.int64)
            for r in count:
                number[r["length"]] = r["n"]
            # Or if another round would hardly save any; :func:`gap` tells what is left.
            last = bins <= least_bins_of(number) or (before is not None and bins > before * (1 - LEAST_FALL))
            before = bins
            if last:
                placed = placed.withColumn("__stays", F.lit(True))
        stay = placed.where("__stays").select(*columns, "sequence_id", "offset")
        done = stay if done is None else done.union(stay)
        if last:
            return done
        rest = placed.where("not __stays").select(*columns, "__row")


def gap(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row on packed pieces: ``n_sequences``, ``lower_bound`` (sequences that
    any packing needs, by the dual feasible functions over all lengths) and
    ``gap``, their difference: 0 certifies the packing as optimal."""
    count = placed.groupBy("length").agg(F.count("*").alias("n")).collect()       # at most `capacity` rows
    number = np.zeros(capacity + 1, np.int64)
    for r in count:
        number[r["length"]] = r["n"]
    bound = F.lit(least_bins_of(number) if count else 0).cast("long")
    return placed.select("sequence_id").distinct().agg(F.count("*").alias("n_sequences")).select(
        "n_sequences", bound.alias("lower_bound"), (F.col("n_sequences") - bound).alias("gap"))


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, group: int = GROUP, added: bool = False) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.  ``added`` is that of :func:`coder`.

    A null or empty text has the closing id only; a null id stays null; a
    repeated row is packed as often as it occurs; an empty table gives an empty
    result.  Columns other than the two named are not read.
    """
    return pack(pieces(docs, vocabulary, id_col, text_col, capacity, added=added), capacity, group)


def sequences(docs: DataFrame, placed: DataFrame, vocabulary: str, id_col: str = "doc_id",
              text_col: str = "text", capacity: int = CAPACITY, added: bool = False) -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and ``input_ids``.
    A piece is found by document, number and checksum, so repeated rows each
    fill the places that were given to them."""
    def key(df, number):
        return df.withColumn("__copy", F.row_number().over(number))
    from pyspark.sql import Window as W
    same = ["doc_id", "piece", "ids_crc32"]
    cut_ = key(pieces(docs, vocabulary, id_col, text_col, capacity, with_ids=True, added=added),
               W.partitionBy(*same).orderBy("start")).select(*same, "__copy", "ids")
    where = key(placed, W.partitionBy(*same).orderBy("sequence_id", "offset"))
    match = cut_["doc_id"].eqNullSafe(where["doc_id"])
    for c in ("piece", "ids_crc32", "__copy"):
        match &= cut_[c] == where[c]
    return (where.join(cut_, match).groupBy("sequence_id")
            .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))),
                                       lambda x: x["ids"])).alias("input_ids")))
