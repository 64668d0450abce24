import random

from tripwright.llm import lines as L

from .conftest import rows_of

BLANK = " \t\n\v\f\r"


def brute(rows, most, min_words=50):
    seen, out = {}, []
    rows = list(dict.fromkeys(rows))
    worded = {r: [i for i, x in enumerate((r[1] or "").split("\n")) if x.strip(BLANK)] for r in rows}
    places = {}
    for r in rows:
        ls = (r[1] or "").split("\n")
        for w in range(1, most + 1):
            for i in range(len(worded[r]) - w + 1):
                body = tuple(ls[k] for k in worded[r][i:i + w])
                if w == most or sum(len(x.encode().split()) for x in body) >= min_words:
                    places.setdefault(body, []).append((r, i))
    order = lambda p: ((p[0][0] is not None, p[0][0] or 0), p[1])
    later = {r: set() for r in rows}
    for body, found in places.items():
        w, first = len(body), min(found, key=order)
        for p in found:
            if p != first:
                later[p[0]].update(worded[p[0]][p[1]:p[1] + w])
    for r in rows:
        ls = (r[1] or "").split("\n")
        text = r[1] if not later[r] else "\n".join(x for i, x in enumerate(ls) if i not in later[r])
        out.append((r[0], len(worded[r]), len(later[r]), text))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(2)
    block = [["p%d line %d" % (p, i) for i in range(rng.randrange(3, 7))] for p in range(5)]
    rows = [(1000, None), (1001, ""), (1002, "\n\n"), (None, "a\nb\nc"), (1003, "a\nb\nc\nd"), (1004, "x\nx\nx\nx\nx"),
            (1005, " a\n\nb\n \nc"), (1006, "a\n\nb\nc"), (1007, "tie\ntie"), (1008, "\n".join("L%d" % i for i in range(900))),
            (1009, "\n".join("L%d" % i for i in range(100, 800)))]
    long = " ".join(f"word{i}" for i in range(50))
    rows += [(1100, long), (1101, f"head\n{long}\nown end"), (1102, f"other\n{long}"), (1103, long[:-8]), (1104, long[:-8]),
             (1105, f"{long[:200]}\n\n{long[200:]} x"), (1106, f"y\n{long[:200]}\n{long[200:]} x"), (1107, long + "\n" + long),
             (1108, "\t".join(["w"] * 49)), (1109, "\t".join(["w"] * 49)), (1110, long + " "), (1111, f"head\n{long}")]
    for i in range(40):
        own = ["own %d %d" % (i, k) for k in range(rng.randrange(0, 5))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + rng.choice(block) + own[at:])))
    return rows


def test_against_brute_force(make_docs):
    rows = corpus()
    got = rows_of(L.line_report(make_docs(rows)), "doc_id", "n_lines", "n_deleted", "text")
    assert got == brute(rows, 3)


def test_equal_rows_are_one_row(make_docs):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc\nd")]
    got = rows_of(L.line_report(make_docs(rows)), "doc_id", "n_deleted", "text")
    assert got == [(1, 0, "a\nb\nc"), (1, 0, "a\nb\nc"), (2, 3, "d")]


def test_keeps_columns_and_rows(make_docs):
    docs = make_docs(corpus())
    out = L.delete_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert L.delete_lines(make_docs([])).collect() == []
    assert L.line_report(make_docs([])).collect() == []
