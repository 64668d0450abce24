"""Unigram token counts with a trie over distinct pre-tokens.

A text is split at ASCII white space; a pre-token is a word with the word
marker before it.  Distinct pre-tokens are inserted in a trie of their bytes.
A node holds the forward score of its prefix - the best sum of piece scores
that spells it - and the number of pieces of that segmentation, computed once
when the node is made, from the nodes above it.  The node where a pre-token
ends has its token count, so words that share a prefix share that work.
"""

from __future__ import annotations

import math
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "▁".encode()
MAX_NODES = 500_000        # of a task's trie; then it starts anew (counts don't change)
LONG = 1024                # bytes of a word that is scored without nodes: it shares no more than that
BYTE_PENALTY = 10.0        # a byte outside the vocabulary scores so much below its rarest piece


@cache
def piece_scores(path: str) -> dict[bytes, float]:
    """Pieces of a sentencepiece file and their scores.  Its vocabulary has
    ranks and no probabilities, so a piece scores as in a Zipf distribution:
    -log(rank).  Every byte is a piece, by itself rarer than any other."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    plain = [i for i in range(sp.get_piece_size())
             if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
    plain.sort(key=lambda i: (-sp.get_score(i), i))
    scores = {sp.id_to_piece(i).encode(): -math.log(n + 2) for n, i in enumerate(plain)}
    floor = -math.log(len(plain) + 2) - BYTE_PENALTY
    for b in range(256):
        scores.setdefault(bytes([b]), floor)
    return scores


class Trie(dict):
    """``trie[word]`` is the token count of a word; distinct words are inserted
    when they are first asked for."""

    def __init__(self, scores: dict[bytes, float], max_nodes: int = MAX_NODES):
        super().__init__()
        self.scores, self.max_nodes = scores, max_nodes
        self.tails = {p[k:] for p in scores for k in range(len(p))}
        self.longest = max(map(len, scores)) + 1
        self._start()

    def _start(self):
        self.clear()
        self.child: dict[int, int] = {}
        self.best, self.count = [0.0], [0]       # by node; 0 is the root

    def __missing__(self, word: bytes) -> int:
        if len(self.best) > self.max_nodes:
            self._start()
        if len(word) > LONG:
            return self.of_long(word)
        child, best, count = self.child, self.best, self.count
        scores, tails = self.scores, self.tails
        token = MARKER + word
        node, path = 0, [0]
        for i, byte in enumerate(token, 1):
            edge = node << 8 | byte
            node = child.get(edge)
            if node is None:
                node = child[edge] = len(best)
                top, pieces = -math.inf, 0
                for j in range(i - 1, -1, -1):
                    piece = token[j:i]
                    if piece not in tails:       # and so no longer one is a piece
                        break
                    s = scores.get(piece)
                    if s is not None:
                        above = path[j]
                        s += best[above]
                        # Of equal scores the segmentation with fewer pieces.
                        if s > top or (s == top and count[above] + 1 < pieces):
                            top, pieces = s, count[above] + 1
                best.append(top)
                count.append(pieces)
            path.append(node)
        self[word] = n = count[node]
        return n

    def of_long(self, word: bytes) -> int:
        """The token count of a word of any length, by the same recurrence over
        as many scores as the longest piece has bytes."""
        scores, tails, longest = self.scores, self.tails, self.longest
        token = MARKER + word
        best, count = [0.0] * longest, [0] * longest          # by prefix length, in a ring
        for i in range(1, len(token) + 1):
            top, pieces = -math.inf, 0
            for j in range(i - 1, max(i - longest, 0) - 1, -1):
                piece = token[j:i]
                if piece not in tails:
                    break
                s = scores.get(piece)
                if s is not None:
                    above = j % longest
                    s += best[above]
                    if s > top or (s == top and count[above] + 1 < pieces):
                        top, pieces = s, count[above] + 1
            best[i % longest], count[i % longest] = top, pieces
        return count[len(token) % longest]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 max_nodes: int = MAX_NODES) -> DataFrame:
    """Id, ``n_words``, ``n_tokens`` and ``n_bytes`` of every row.

    Null and empty texts have none; a null id stays null; repeated rows are
    counted each; an empty table gives an empty result.  Only the two named
    columns are read.
    """
    def run(batches):
        trie = Trie(piece_scores(vocabulary), max_nodes)
        for b in batches:
            words, tokens, size = [], [], []
            for t in b.column(1):
                text = t.as_py() or b""
                split = text.split()             # bytes: ASCII white space only
                words.append(len(split))
                tokens.append(sum(map(trie.__getitem__, split)))
                size.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array(size, pa.int64())], ["id", "n_words", "n_tokens", "n_bytes"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, f"id {kind}, n_words long, n_tokens long, n_bytes long").withColumnRenamed("id", id_col)
