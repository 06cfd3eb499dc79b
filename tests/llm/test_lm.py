import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import lm

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def tokens_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), ""]


def slow_base(rows):
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    counts = Counter(w for d, t in rows if not out(d) for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    found = []
    for d, t in rows:
        words = tokens_of(t)
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        found.append((d, out(d), len(words), sum(counts[w] > 0 for w in words), n, round(score, 6)))
    return found


def check(df, **kw):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = lm.language_model(df, **kw).collect()
    assert [*got[0].asDict()] == COLUMNS
    assert sorted(map(str, slow_base(rows))) == sorted(str((*r[:5], round(r.base_score, 6))) for r in got)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    return got


@pytest.mark.parametrize("chunk_bytes", [1 << 24, 20_000])
def test_base_equals_brute_force_and_model_beats_it(spark, chunk_bytes):
    got = check(spark.read.parquet(f"{FOLDER}/documents.parquet"), chunk_bytes=chunk_bytes)
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(docs_of):
    rows = [(1, None), (2, ""), (2, ""), (3, " \n"), (None, "no id"), (4, "A a a B"), (5, "é É ß\x0bx"), (6, "word " * 30_000), (7, "never seen before")]
    check(docs_of(rows, ids="1", words="2", score="3"))


def test_no_rows_and_no_training_rows(docs_of):
    assert lm.language_model(docs_of([])).count() == 0
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    got = lm.language_model(docs_of([(held, "a b")])).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in got] == [(0, 0, 0.0)] and math.isfinite(got[0].score)


def test_probabilities_sum_to_one():
    """Over all leaves, after any training, and over the words of a shared leaf with its unknown event."""
    rng = np.random.default_rng(3)
    weights = lm.Weights.start(rng.integers(0, 50, lm.CLASSES * lm.MEMBERS).astype(float))
    feature = rng.integers(0, 2**63, (500, lm.CONTEXTS)).astype(np.uint64)
    for _ in range(5):
        lm.train_batch(weights, feature, rng.integers(0, 512, 500), 0.1)
    total = np.zeros(3)
    for leaf in range(lm.CLASSES * lm.MEMBERS):
        p_class, p_member, classes, member, _, _ = lm.chances(weights, feature[:3], np.full(3, leaf))
        total += p_class[np.arange(3), classes] * p_member[np.arange(3), member]
    assert np.allclose(total, 1, atol=1e-3)


def test_step_is_the_gradient():
    rng = np.random.default_rng(4)
    table, rows = np.zeros((50, 4), np.float32), rng.integers(0, 50, (30, 2))
    slope = rng.normal(size=(30, 4)).astype(np.float32)
    want = np.zeros((50, 4))
    for r, s in zip(rows, slope):
        for k in r:
            want[k] -= 0.5 * s
    uses = np.bincount(rows.ravel(), minlength=50)
    lm.step(table, rows, slope, 0.5)
    assert np.allclose(table, want / np.sqrt(np.maximum(uses, 1))[:, None], atol=1e-5)


def test_training_learns_a_pattern():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 20, 4000)
    ids[1::2] = (ids[::2] * 7 + 3) % 20
    hashes = rng.integers(0, 2**63, 20).astype(np.uint64)
    weights = lm.Weights.start(np.bincount(ids, minlength=512).astype(float))
    feature, leaf = lm.contexts(ids, lm.place_in_text(np.array([len(ids)])), hashes, 0, len(ids)), ids
    loss = lambda: (lambda c: -np.log(c[0][np.arange(4000), c[2]] * c[1][np.arange(4000), c[3]]).mean())(lm.chances(weights, feature, leaf))
    before = loss()
    for _ in range(20):
        lm.train_batch(weights, feature, leaf, 0.15)
    assert loss() < before - 0.5


def test_contexts_of_slices_are_those_of_the_whole():
    rng = np.random.default_rng(6)
    ids, lens = rng.integers(0, 50, 200), np.array([1, 2, 3, 94, 1, 99])
    hashes = rng.integers(1, 2**63, 50).astype(np.uint64)
    into = lm.place_in_text(lens)
    whole = lm.contexts(ids, into, hashes, 0, 200)
    for size in (1, 2, 3, 7):
        assert (np.concatenate([lm.contexts(ids, into, hashes, a, min(200, a + size)) for a in range(0, 200, size)]) == whole).all()
    assert (whole[0] == whole[1]).all() and not (whole[0] == whole[2]).all()
    assert (lm.unpacked(lm.packed(ids * 70_001)) == ids * 70_001).all()
