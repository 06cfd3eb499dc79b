import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickloom.llm import simhash

FOLDER = "/root/testdata/sf0.001"


def slow_print(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def slow_classes(prints, ids, radius=4):
    label = list(range(len(prints)))
    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(prints))]


def check(df, got):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    prints = [slow_print(t) for _, t in rows]
    want = [(d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, slow_classes(prints, [d for d, _ in rows]))]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())


def test_whole_table_equals_brute_force(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    check(df, simhash.near_duplicates(df))


def test_odd_rows(docs_of):
    long = " ".join(f"w{i % 977}" for i in range(70_000))
    df = docs_of([(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (5, "ONE"), (6, "a b c"), (7, "É é a b c d"),
                  (None, "lonely text of no id at all"), (8, long), (9, long + " x"), (4, "one two three four five")],
                 fingerprint="1", component_id="2", _row="3", fp="4")
    check(df, simhash.near_duplicates(df))


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0


def signed(x):
    return x - 2**64 if x >> 63 else x


def components(df, keys, radius, words, part, prints):
    """Least index per node after following the links."""
    label = list(range(len(prints)))
    for r in simhash.links_of(df, keys, radius, words, part).collect():
        a, b = label[r.a], label[r.b]
        label = [min(a, b) if x in (a, b) else x for x in label]
    return label


@pytest.mark.parametrize("part", [2048, 5])
def test_links_of_dense_and_sparse_prints(spark, part):
    rng = random.Random(part)
    prints = {0, 2**64 - 1}
    for _ in range(30):
        p = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 40)):
            prints.add(p)
            for _ in range(rng.randrange(1, 4)):
                p ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    df = spark.createDataFrame([(i, [signed(p)]) for i, p in enumerate(prints)], "node bigint, print array<bigint>")
    keys = simhash.untouched_keys(F.get("print", 0), 4, 6)
    assert components(df, keys, 4, 1, part, prints) == slow_classes(prints, list(range(len(prints))))


@pytest.mark.parametrize("part", [2048, 7])
def test_wide_prints_link_where_a_key_and_the_radius_allow(spark, part):
    rng = random.Random(part)
    prints = []
    for _ in range(25):
        p = rng.getrandbits(256)
        for _ in range(rng.randrange(1, 12)):
            prints.append(p)
            for _ in range(rng.randrange(10, 70)):
                p ^= 1 << rng.randrange(256)
    df = spark.createDataFrame([(i, [signed(p >> 64 * k & (2**64 - 1)) for k in range(4)]) for i, p in enumerate(prints)], "node bigint, print array<bigint>")
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            x = prints[i] ^ prints[j]
            if x.bit_count() <= 44 and any(not x >> 16 * t & 0xFFFF for t in range(16)):
                a, b = label[i], label[j]
                label = [min(a, b) if y in (a, b) else y for y in label]
    assert components(df, simhash.banded_keys(F.col("print"), 16), 44, 4, part, prints) == label


def test_wide_fingerprint_starts_with_the_narrow_one():
    text = " ".join(f"w{i}" for i in range(300)).encode()
    wide = simhash.fingerprint(text, 5, 10)
    assert len(wide) == 10 and wide[0] == simhash.fingerprint(text, 5)[0]
    ones = np.unpackbits(wide.view(np.uint8)).sum()
    assert 250 < ones < 390


def test_similar_texts_are_caught_and_others_stay(docs_of):
    """Groups of copies at similarity 0.87 and 0.5 of five-word shingles."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    rows, near, far = [], 0, 0
    for group in range(60):
        words = [word() for _ in range(300)]
        rows.append((10 * group, " ".join(words)))
        for k, edits in ((1, 4), (2, 25)):
            copy = list(words)
            for at in rng.sample(range(300), edits):
                copy[at] = word()
            rows.append((10 * group + k, " ".join(copy)))
    kept = {r.doc_id for r in simhash.keep_one(docs_of(rows)).collect()}
    assert all(10 * g in kept for g in range(60))
    assert sum(10 * g + 1 in kept for g in range(60)) <= 3
    assert sum(10 * g + 2 in kept for g in range(60)) >= 50


def test_one_of_each_group_stays(docs_of):
    text = " ".join(f"word{i}" for i in range(300))
    df = docs_of([(5, text), (3, text), (3, text), (9, text.replace("word7 ", "other ")), (1, "something else entirely here"),
                  (None, "no id one two three"), (None, "no number five six seven eight"), (2, None), (4, "")], n="7", fp="text")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 3]


def test_pairs_around_the_threshold_go_by_exact_similarity(docs_of):
    """Copies with an edited end: of 105 five-word shingles so many are shared that the similarity is just above or below 0.8."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows, want = [], set()
    for group in range(80):
        words = [word() for _ in range(109)]
        rows.append((10 * group, " ".join(words)))
        want.add(10 * group)
        for k, edits in ((1, 11), (2, 12), (3, 16), (4, 22)):     # 94/116 = 0.810, 93/117 = 0.795, 0.735, 0.654
            rows.append((10 * group + k, " ".join(words[:-edits] + [word() for _ in range(edits)])))
            want |= {10 * group + k} if k > 1 else set()
    # Links among the copies themselves: all share less than the longer prefix lets them.
    assert {r.doc_id for r in simhash.keep_one(docs_of(rows)).collect()} == want


def test_equal_fingerprints_of_unlike_sets_stay(docs_of):
    """One shingle makes up most of the text, so that it alone decided the bits."""
    rows = [(i, "x " * 300 + " ".join(f"own{i}w{k}" for k in range(60))) for i in range(4)]
    assert {r.doc_id for r in simhash.keep_one(docs_of(rows)).collect()} == {0, 1, 2, 3}


def test_links_beyond_the_first_neighbour_are_checked(docs_of):
    """A hub that is like nobody enough (0.7) comes before pairs that are copies of each other."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base = [word() for _ in range(204)]
    rows = [(0, " ".join(base))]
    for k in range(1, 13):
        words = base[:165] + [word() for _ in range(39)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:-6] + [word() for _ in range(6)]))]
    assert {r.doc_id for r in simhash.keep_one(docs_of(rows)).collect()} == {2 * k for k in range(13)}
