import hashlib
import re

import numpy as np

from clickloom.llm import pii

FOLDER = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def slow_luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def slow(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    tests = {
        "email": (EMAIL, lambda s: True), "ip": (IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (CARD, lambda s: 16 <= len(digits(s)) <= 19 and slow_luhn(digits(s))), "phone": (PHONE, lambda s: 8 <= len(digits(s)) <= 15),
    }
    return [(kind, m.start(), m.end()) for kind, (pattern, ok) in tests.items() for m in pattern.finditer(text) if ok(m[0])]


ODD = [None, "", "a@b", "a@b.c", "x@@y.z @a.b a@b.c.d.", "a.b+c%d-e@f-g.h-i, x@y.z@w.v", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 1.2.3",
       "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111111 4111  1111", "+1 (555) 123-4567. +123 +1.2 +49 30 1234567890123456",
       "é mail: ñ@é.x ñ a@x.y 🙂 b@x.y", "@" * 2000 + "a@b.c", "a" * 20_000 + "@" + "b" * 20_000 + ".c", "1" * 5000, "1." * 5000, "+" * 500 + "1" * 500]


def check(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = []
    for d, t in rows:
        spans = slow(t)
        counts = [sum(k == kind for k, _, _ in spans) for kind in pii.BASE]
        want.append((d, *counts, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()))
    got = pii.personal_data(df).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:6]) for r in got)
    for r in got:
        texts = [t for d, t in rows if d == r.doc_id]
        base = {f"{k}:{s}:{e}" for t in texts for k, s, e in slow(t)}
        assert len(texts) > 1 or base <= set(r.spans.split(","))
        order = [(pii.KINDS.index(k), int(s)) for k, s, _ in (x.split(":") for x in r.spans.split(",") if x)]
        assert order == sorted(order)
    return got


def test_whole_table_equals_brute_force(spark):
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in check(spark.read.parquet(f"{FOLDER}/documents.parquet"))) > 10


def test_odd_rows(docs_of):
    check(docs_of([*enumerate(ODD), (50, "x@y.zz"), (50, "x@y.zz"), (None, "1.2.3.4")], spans="1", base="2", loose="3"))
    assert pii.personal_data(docs_of([])).count() == 0


def test_written_out_data_is_added_and_numbers_are_not(docs_of):
    rows = [(i, f"Contact: user{i}@mail.example.com or call +1 (555) 01{i:02d}-4567 today.") for i in range(60)]
    rows += [(100 + i, f"Please mail user{i}(at)mail(dot)example.com about it.") for i in range(30)]
    rows += [(200 + i, f"Invoice number 2024-03-{1 + i % 28:02d} total 1 000 {100 + i} of order 12.345.{100 + i}") for i in range(60)]
    got = {r.doc_id: r for r in check(docs_of(rows))}
    assert sum(got[100 + i].n_added for i in range(30)) >= 25
    assert sum(got[200 + i].n_added for i in range(60)) == 0
    assert "email:12:" in got[100].spans


def test_reliabilities_tell_good_labelers():
    """Two good labelers and a random one: beliefs follow the good ones."""
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    good = lambda p: np.where(rng.random(4000) < p, np.where(truth, 1, -1), np.where(truth, -1, 1))
    cast = np.zeros((4000, 8), int)
    cast[:, 0] = np.where(truth & (rng.random(4000) < 0.7), 1, 0)
    cast[:, 2], cast[:, 5], cast[:, 6] = good(0.9), good(0.9), good(0.5)
    belief = pii.expectation_maximisation(np.zeros(4000, int), cast, np.ones(4000))
    assert ((belief > 0.5) == truth).mean() > 0.9
