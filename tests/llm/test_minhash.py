import random
import re

import numpy as np
import pytest
import xxhash

from clickloom.llm import minhash, similar

FOLDER = "/root/testdata/sf0.001"


def slow_set(text, width=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def slow_rows(rows):
    sets = [slow_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and label[i] != label[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), k in zip(rows, label):
        if d is not None:
            least[k] = min(d, least.get(k, d))
    return sorted(str((d, len(s), least.get(k), d == least.get(k))) for (d, _), s, k in zip(rows, sets, label))


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = minhash.near_duplicates(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(str(tuple(r)) for r in got.collect()) == slow_rows(rows)


def words(rng, n, of=400):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def test_whole_table_equals_brute_force(spark):
    check(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_odd_rows(docs_of):
    long = " ".join(f"w{i * i % 9973}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t\v "), (4, "one"), (5, "ONE"), (5, "ONE"), (6, "one one"), (7, "one one one"), (8, "É é É"),
            (9, long), (10, long + " x y z"), (None, long), (None, "no id at all here"), (4, "other words with the same id")]
    check(docs_of(rows, component_id="1", set="2", _r="'x'", node="3"))


def test_empty_table(docs_of):
    assert minhash.near_duplicates(docs_of([])).collect() == []


def test_exact_threshold(docs_of):
    """8 of 10 shingles in common is a link, one less is none."""
    base = [f"a{i}" for i in range(10)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1] + ["x"])), (3, " ".join(["b0", *(f"b{i}" for i in range(1, 9))])),
            (4, " ".join([*(f"b{i}" for i in range(8)), "y"])), (5, " ".join([*(f"b{i}" for i in range(9)), "z"]))]
    check(docs_of(rows))


def test_groups_around_the_threshold(docs_of):
    """Groups of edited texts, dense ones below 0.8 and chains included, against brute force."""
    rng, rows = random.Random(7), []
    for group, (n, edits) in enumerate([(60, 3), (60, 6), (60, 9), (40, 12), (40, 20)]):
        base = [f"g{group}_{w}" for w in words(rng, 120)]
        for _ in range(n):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    check(docs_of(rows))


def test_units_of_several_parts_find_the_same(spark):
    """Small parts, so that a cluster is many units: the same components as one part."""
    rng, sets = random.Random(3), []
    base = list(range(1, 81))
    for _ in range(70):
        mine = set(base)
        for _ in range(rng.randrange(14)):
            mine.discard(rng.choice(base))
            mine.add(rng.randrange(1000, 10**6))
        sets.append(sorted(mine))
    full = spark.createDataFrame([(i, len(s), [s[:50], s[50:]]) for i, s in enumerate(sets)], "node bigint, size bigint, chunks array<array<bigint>>")
    candidates = spark.createDataFrame([(i, 0) for i in range(1, len(sets))], "a bigint, b bigint")
    found = []
    for rows in (512, 9, 4):
        links = similar.linked(full, candidates, full, 80, rows=rows)
        found.append(sorted((r.node, r.root) for r in similar.rooted(full.select("node"), links).collect()))
    want = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(set(sets[i]) & set(sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((want[i], want[j]))
                want = [a if x == b else x for x in want]
    assert found[0] == found[1] == found[2] == list(enumerate(want))
    assert 5 < len(set(want)) < 65


@pytest.mark.parametrize("size", [1, 2, 7, 100, 5000])
def test_sketches_are_full_and_agree_as_often_as_sets_do(size):
    rng = np.random.default_rng(size)
    agree = []
    for _ in range(40 if size < 1000 else 8):
        both, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (size, size // 4, size // 4))
        x, y = minhash.sketch(np.r_[both, a]), minhash.sketch(np.r_[both, b])
        assert (x != minhash.EMPTY).all()
        agree.append((x == y).mean())
    assert abs(np.mean(agree) - size / (size + 2 * (size // 4))) < 0.03


def test_batches_of_rounds_do_not_change_a_sketch(monkeypatch):
    members = np.array([xxhash.xxh64_intdigest(b"%d" % i) for i in range(50)], np.uint64)
    want = minhash.sketch(members)
    monkeypatch.setattr(minhash, "THROWS", 50)
    assert (minhash.sketch(members) == want).all()
