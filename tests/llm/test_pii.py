import hashlib
import random
import re
import time

from tripwright.llm import pii as P

from .conftest import rows_of

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+".replace(r"\x20-", r"\x20\-"))
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(x):
    return [int(c) for c in x if c in "0123456789"]


def luhn(ds):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(ds[::-1])) % 10 == 0


def brute(text):
    text = text or ""
    good = (lambda m: True, lambda m: all(int(x) <= 255 for x in m.split(".")),
            lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)), lambda m: 8 <= len(digits(m)) <= 15)
    return [(k, *m.span()) for k, (r, ok) in enumerate(zip((EMAIL, IP, CARD, PHONE), good, strict=True))
            for m in r.finditer(text) if ok(m.group())]


def shown(spans):
    return ",".join(f"{P.KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def test_base_against_plain_patterns():
    rng = random.Random(5)
    for alphabet in ("a.@-1 ", "12.", "0123456789 -", "+1() .-2", "a1@.+ -(é", "@a.b"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert P.base_spans(text) == brute(text), text
    number = "4000000000000002"
    for text in (number, number[:4] + " " + number[4:8] + "-" + number[8:], "1.2.3.4.5.6.7.8.9", "999.1.1.1.1", "0001.2.3.4",
                 "a@b.c@d.e", "@a.b@c.d", "é+1 (132) 555-1352.", "+1 2", "1" * 40):
        assert P.base_spans(text) == brute(text), text


PLACES = ["lyon", "bern", "graz", "turin", "essen", "malmo", "ghent", "porto", "leeds", "split"]


def corpus():
    """Phones after "reach me on", cards after "charged to", mails after "write
    to"; numbers of the same shapes after other words."""
    rng = random.Random(3)
    rows = []
    for i in range(30):
        rows.append((i, f"{PLACES[i % 10]} reach me on +49 30 555{i:04d} or write to u{i}@host{i}.example soon"))
    for i in range(30, 33):     # no plus sign, no host with a dot, other words around
        rows.append((i, f"please reach me on 030 555-{i:04d} tonight"))
        rows.append((i + 100, f"or write to u{i} [at] host{i} [dot] example now"))
    for i in range(40, 70):     # the same shapes where nothing says so
        rows.append((i, f"order {rng.choice(PLACES)} part 030 555-{i:04d} shipped u{i}@local"))
    rows += [(200, None), (201, ""), (None, "reach me on 030 777-0001"), (202, rows[0][1]), (202, rows[0][1]),
             (203, "x" * 100_000 + " reach me on 030 777-0002")]
    return rows


def test_finds_unseen_identifiers(make_docs):
    rows = corpus()
    got = P.personal_data(make_docs(rows)).collect()
    assert len(got) == len(rows)
    added = {}
    for r in got:
        text = dict(rows)[r.doc_id]
        base = brute(text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(shown(base).encode()).hexdigest()
        spans = [x for x in r.spans.split(",") if x]
        assert set(shown(base).split(",")) - {""} <= set(spans) and len(spans) == len(base) + r.n_added
        for x in set(spans) - set(shown(base).split(",")):
            kind, s, e = x.split(":")
            added.setdefault(r.doc_id, []).append((kind, text[int(s):int(e)]))
    want = {i: [("phone", f"030 555-{i:04d}")] for i in range(30, 33)}
    want |= {i + 100: [("email", f"u{i} [at] host{i} [dot] example")] for i in range(30, 33)}
    want |= {None: [("phone", "030 777-0001")], 203: [("phone", "030 777-0002")]}
    assert added == want


def test_later_rounds_learn_from_what_was_found(make_docs):
    """"dial" never stands before a seed: its instances are found through
    "phone", and through it an instance that "phone" never precedes."""
    rows = [(i, f"phone +44 20 700{i:04d} {PLACES[i % 10]}") for i in range(300)]
    rows += [(1000 + i, f"{p} 020 800{i:04d} x") for i in range(20) for p in ("phone", "dial")]
    rows += [(2000, "dial 020 9000001 y")]
    one = dict(rows_of(P.personal_data(make_docs(rows), rounds=1), "doc_id", "n_added"))
    three = dict(rows_of(P.personal_data(make_docs(rows), rounds=3), "doc_id", "n_added"))
    assert one[2000] == 0 and three[2000] == 1


def test_copies_are_one_instance(make_docs):
    """A text copied many times makes no pattern."""
    rows = [(i, "zone +44 20 7000000 end") for i in range(50)] + [(99, "zone 020 7000001 end")]
    assert sum(r.n_added for r in P.personal_data(make_docs(rows)).collect()) == 0


def test_empty_table(make_docs):
    assert P.personal_data(make_docs([])).collect() == []


def test_long_degenerate_texts():
    n = 1_000_000
    for unit in ("a", "1", "1 ", "1.", "@", "a@", "+1", "a at b dot ", "f", ":", "1:", " ", "(", "1234567 "):
        text = unit * (n // len(unit))
        start = time.time()
        P.slots(text, P.base_spans(text))
        assert time.time() - start < 20, unit
