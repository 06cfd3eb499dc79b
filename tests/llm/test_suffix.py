import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import suffix

FOLDER = "/root/testdata/sf0.001"


def slow(texts, length=400):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        found.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return found


def check(df, **kw):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = [(d, *x) for (d, _), x in zip(rows, slow([t for _, t in rows], kw.get("length", 400)))]
    got = [tuple(r) for r in suffix.repeated_bytes(df, **kw).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    return got


def test_whole_table_equals_brute_force(spark):
    got = check(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    assert any(n for _, _, n, _, _ in got)


@pytest.mark.parametrize("batches", [1, 7])
def test_many_contexts(docs_of, batches):
    rng = random.Random(batches)
    letters = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    shared = [letters(n) for n in (390, 399, 400, 401, 450, 900, 3000)]
    texts = [None, "", "x" * 399, "x" * 400, "y" * 1000, "ab" * 500, "ab" * 399]
    for _ in range(40):
        text = letters(rng.randrange(0, 300))
        for _ in range(rng.randrange(3)):
            piece = rng.choice(shared)
            a = rng.randrange(0, 200)
            text += piece[a if rng.random() < 0.5 else 0:] + letters(rng.randrange(0, 300))
        texts.append(text)
    texts += [texts[-1], texts[-1][:700] + "!" + texts[-1][701:], texts[20], texts[20]]
    rows = [(i % 45 if i % 7 else None, t) for i, t in enumerate(texts)]
    check(docs_of(rows, chunk="1", marks="2", starts="3"), batches=batches, chunk_bytes=5000)


def test_short_strings_and_segments(docs_of, monkeypatch):
    monkeypatch.setattr(suffix, "SEGMENT", 97)
    text = " ".join(str(i * i) for i in range(900))
    places, low, high = suffix.anchors(text.encode(), 100)
    assert low[0] == 0 and high[-1] == len(text.encode()) - 100 and (low[1:] == high[:-1] + 1).all()
    assert ((places >= high) & (places + suffix.GRAM <= low + 100)).all()
    check(docs_of([(1, text), (2, text[1000:1300] + "tail" * 60), (3, "head" + text[500:640] + "x" + text[2000:2099])]), length=100)


def test_kept_texts(docs_of):
    shared = " ".join(f"s{i}" for i in range(150))
    rows = [(1, "a " + shared + " b"), (2, "c " + shared + " d"), (3, "unlike anything")]
    got = {r.doc_id: r.kept for r in suffix.without_repeats(docs_of(rows)).collect()}
    assert got == {1: b"ab", 2: b"cd", 3: b"unlike anything"}


def test_empty_table(docs_of):
    assert suffix.repeated_bytes(docs_of([])).count() == 0


def test_levels_merge_geometrically(spark):
    family = suffix.SuffixFamily()
    ranks = []
    for batch in range(7):
        family.add(spark.createDataFrame([(batch, 1), (100, batch % 2), (50 + batch, 2)], "gram bigint, context bigint"))
        ranks.append([rank for rank, _ in family.levels])
    assert ranks == [[0], [1], [1, 0], [2], [2, 0], [2, 1], [2, 1, 0]]
    found = {(r.gram, r.mixed) for r in family.repeated().collect()}
    assert found == {(100, True)}


def test_merged_levels_are_deleted(spark):
    family, seen = suffix.SuffixFamily(), []
    for batch in range(4):
        family.add(spark.createDataFrame([(1, 7), (2, batch), (3, 10 + batch)], "gram long, context long"))
        seen += [p for p in sum(family.paths, []) if p not in seen]
    assert len(seen) == 4 and [os.path.isdir(p.removeprefix("file://")) for p in seen] == [False] * 3 + [True]
    assert {(r.gram, r.mixed) for r in family.repeated().collect()} == {(1, False), (2, True), (3, True)}
    family.clear()
    assert not os.path.isdir(seen[-1].removeprefix("file://"))
