import hashlib
import math
import random

import numpy as np

from tripwright.llm import codes as C

from .conftest import rows_of


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [max(-C.LIMIT, min(C.LIMIT, math.floor(256 * float(np.float32(x))))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ids = sorted({i for i, _, _ in kept if i is not None})[:entries]
    first = [min(v for j, v, _ in kept if j == i) for i in ids]
    if not first or not first[0] or len(first[0]) % parts:
        return [], None
    dims = len(first[0])
    w = dims // parts
    first = [v for v in first if len(v) == dims]
    kept = [r for r in kept if len(r[1]) == dims]
    books = [[v[p * w:(p + 1) * w] for v in first] for p in range(parts)]
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))
                 for p, x in enumerate(v)] for v in cut]
    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[r][p] for r in range(len(kept)) if got[r][p][1] == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    got = assign()
    sums = {}
    for (_, _, label), g in zip(kept, got, strict=True):
        sums[label] = sums.get(label, 0) + sum(d for d, _ in g)
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, "".join("%02x" % e for _, e in g), sum(d for d, _ in g), sums[label], sha)
                   for (i, _, label), g in zip(kept, got, strict=True)), key=repr), books


COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", "clash", "clash") for i, v, label in rows],
                                 "vec_id long, embedding array<float>, label int, id string, v string, code string")


def vectors(n, dims, rng, spread=1.0):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([0, 1, 2, None])) for i in range(n)]


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = vectors(150, 32, rng, 0.3)
    rows += [(7, rows[7][1], 3), (8, rows[3][1], 1), (None, rows[5][1], 0), (None, rows[6][1], None), (500, None, 0),
             (501, [None, *rows[0][1][1:]], 0), (502, [math.nan, *rows[0][1][1:]], 0), (503, [math.inf, *rows[0][1][1:]], 0),
             (504, rows[0][1][:16], 1), (505, [], 1), (506, [3e38, *rows[0][1][1:]], 1), (507, [-0.001] * 32, 1),
             *((600 + i, rows[9][1], 1) for i in range(40))]
    got = rows_of(C.compress(table(spark, rows).repartition(5)), *COLUMNS)
    assert got == brute(rows)[0]


def test_few_or_unusable_vectors(spark):
    rng = random.Random(2)
    few = vectors(9, 16, rng)
    assert rows_of(C.compress(table(spark, few)), *COLUMNS) == brute(few)[0]
    for rows in ([], [(1, None, 0)], [(1, [1.0] * 10, 0)], [(1, [], 0)], [(None, [1.0] * 16, 0)]):
        assert C.compress(table(spark, rows)).collect() == []


def test_ball_step_is_exact_and_skips(monkeypatch):
    """From any start a step gives the nearest entry, ties to the lower; parts
    in the stable cores are compared with nothing but their entry."""
    rng = np.random.default_rng(3)
    for width, spread, scale in ((4, 6, 1), (4, 40, 1), (1, 3, 1), (2, 30, 1 << 19)):
        c = rng.integers(-40, 40, (30, width)) * scale
        c[7] = c[3]                                            # equal entries
        x = c[rng.integers(0, 30, 4000)] + rng.integers(-spread, spread + 1, (4000, width)) * scale
        want, d = C.nearest(x, c)
        before = want.copy()
        stray = rng.random(4000) < 0.2
        before[stray] = rng.integers(0, 30, stray.sum())
        reach = np.zeros(30, np.int64)
        np.maximum.at(reach, before, np.sqrt(((x - c[before]) ** 2).sum(1)).astype(np.int64) + 1)
        compared = []
        plain = C.distances
        near = C.neighbours(c, reach)
        monkeypatch.setattr(C, "distances", lambda a, b: (compared.append(len(a) * len(b)), plain(a, b))[1])
        at, best = C.ball_step(x, before, c, near)
        monkeypatch.setattr(C, "distances", plain)
        assert (at == want).all() and (best == d).all()
        assert sum(compared) < 4000 * 30


def test_moved_reach_bounds_the_balls(spark):
    rng = random.Random(4)
    rows = vectors(200, 16, rng)
    done, books = C.codebooks(table(spark, rows), "vec_id", "embedding", "label", entries=8, rounds=1)
    v = np.array([r.v for r in done.collect()])
    start = C.Codebooks(np.stack(np.split(v[np.argsort([r.id for r in done.collect()])][:8], 16, axis=1)))
    for p in range(16):
        at, _ = C.nearest(v[:, p:p + 1], start.entries[p])
        far = np.sqrt(((v[:, p:p + 1] - books.entries[p][at]) ** 2).sum(1))
        assert (far <= books.reach[p][at]).all()
