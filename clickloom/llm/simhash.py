"""SimHash near-duplicates: fingerprints of word shingles, linked when few bits differ.

A fingerprint has one or more words of 64 bits. Equal ones are collapsed first; the distinct ones are dealt into tables
by some of their bits and compared where they share a bucket. There, fingerprints are stored as vertical bit planes, 64
of them to a machine word; one query meets a word in xor steps whose results are summed by carry-save adders, and a word
is abandoned when all its lanes exceed the radius.

* ``near_duplicates`` takes one word and finds *all* links of a small radius: the 64 bits are cut into ``BLOCKS`` runs, and
  at most ``radius`` differing bits leave ``BLOCKS - radius`` runs untouched, which key the tables.
* ``keep_one`` takes texts whose sets of shingles have a given Jaccard similarity. Their fingerprints differ in a sixth of
  the bits and more, so no bits are surely untouched; ``TABLES`` tables are keyed by ``ROWS`` least hashes each instead, of
  which texts of similarity 0.8 share a key in all but 2 of 10,000 cases. Within a table, ``COMPARED`` words are compared at
  what the similarity lets expect plus ``DEVIATIONS`` standard deviations. That only finds candidates, and of these what connects
  them, not all pairs; ``similar.linked`` compares full sets inside its tasks, and only pairs that reach the similarity are links.

Defined results: null or blank texts have fingerprint zero; a text with fewer words than a shingle is one shingle;
a component without any doc_id has a null component_id; repeated rows are rows like any other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.base import KEY, keyed, lists, raw_texts, shingles, star_forest
from clickloom.llm.similar import chunked_size, linked, shingle_chunks
from clickloom.session import materialize

WIDTH, RADIUS = 4, 4
BLOCKS = 6            # 15 tables of 21-bit keys; 8 gives 70 tables of 32-bit keys for tens of billions of documents
BUCKET_PART = 2048    # larger buckets are cut into parts, and each pair of parts is a unit of work
TABLES, ROWS, COMPARED = 12, 3, 4     # of similar texts: tables, least hashes in a key, words that are compared
DEVIATIONS = 5        # candidates at the similarity are lost once in a million, of texts of a few words once in a thousand
SIMILAR_WIDTH, SIMILARITY = 5, 0.8
PAIRS = 1 << 15       # (query, word) pairs that are compared at once
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
ODD = np.uint64(0x9E3779B97F4A7C15)


def hash_words(hashes: np.ndarray, words: int) -> np.ndarray:
    """Further words of hash bits (columns) from 64-bit hashes, which are the first one."""
    found = [hashes]
    for _ in range(1, words):
        mixed = (found[-1] ^ (found[-1] >> np.uint64(31))) * ODD
        found.append(mixed ^ (mixed >> np.uint64(29)))
    return np.stack(found, axis=1)


def majority(hashes: np.ndarray, words: int) -> np.ndarray:
    """The bits that more than half of the hashes have."""
    total, n = np.zeros(64 * words, np.int64), len(hashes)
    for at in range(0, n, 1 << 14):
        bits = np.unpackbits(hash_words(hashes[at:at + (1 << 14)], words).view(np.uint8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(total * 2 > n, bitorder="little").view(np.uint64)


def fingerprint(raw: bytes, width: int = WIDTH, words: int = 1) -> np.ndarray:
    """The words of a text's fingerprint, the lowest bits first."""
    return majority(shingles(raw, width), words)


def least_keys(hashes: np.ndarray, tables: int) -> np.ndarray:
    """One key per table: the least hashes of a set in ``ROWS`` orders, mixed."""
    salts = np.array([xxhash.xxh64_intdigest(b"%d" % k) | 1 for k in range(tables * ROWS)], np.uint64)
    least = np.full(len(salts), FULL)
    for at in range(0, len(hashes), 1 << 14):
        mixed = (hashes[at:at + (1 << 14)] ^ salts[:, None]) * ODD
        mixed = (mixed ^ (mixed >> np.uint64(32))) * salts[:, None]
        least = np.minimum(least, mixed.min(axis=1))
    least = (least ^ (least >> np.uint64(29))) * salts[::-1]
    return least.reshape(tables, ROWS).sum(axis=1, dtype=np.uint64)


def set_print(raw: bytes, width: int, words: int, tables: int) -> np.ndarray:
    """Of a text's set of shingles: the words of its fingerprint, its keys, and two words that identify it."""
    members = np.unique(shingles(raw, width))
    identity = np.frombuffer(xxhash.xxh3_128_digest(members.tobytes()), np.uint64)
    return np.concatenate([majority(members, words), least_keys(members, tables), identity])


def fingerprints(text: Column, width: int = WIDTH, words: int = 1) -> Column:
    @F.arrow_udf("array<bigint>")
    def compute(texts: pa.Array) -> pa.Array:
        return lists([fingerprint(x, width, words) for x in raw_texts(texts)])

    return compute(text)


def set_prints(text: Column, width: int, words: int, tables: int) -> Column:
    @F.arrow_udf("array<bigint>")
    def compute(texts: pa.Array) -> pa.Array:
        return lists([set_print(x, width, words, tables) for x in raw_texts(texts)])

    return compute(text)


def expected_radius(similarity: float, bits: int) -> int:
    """Differing bits that texts of this Jaccard similarity have, and ``DEVIATIONS`` standard deviations more."""
    rate = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * rate + DEVIATIONS * math.sqrt(bits * rate * (1 - rate)))


def full_adder(a, b, c):
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def over_radius(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose vertical counter (lowest plane first) is above the radius."""
    above, equal = np.zeros_like(counter[0]), np.full_like(counter[0], FULL)
    for k in range(len(counter) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counter[k]
        else:
            above |= equal & counter[k]
            equal &= ~counter[k]
    return above


def close_lanes(planes: np.ndarray, bits: np.ndarray, query: np.ndarray, word: np.ndarray, lanes: np.ndarray, radius: int):
    """The (query, word) pairs that still hold close lanes, and these lanes as bits of a word."""
    over = ~lanes
    count = [np.zeros(len(query), np.uint64) for _ in range(max(4, radius.bit_length()))]
    for first in range(0, len(planes), 8):
        d = [planes[p, word] ^ (np.uint64(0) - bits[query, p].astype(np.uint64)) for p in range(first, first + 8)]
        ones, a = full_adder(count[0], d[0], d[1])
        ones, b = full_adder(ones, d[2], d[3])
        twos, e = full_adder(count[1], a, b)
        ones, a = full_adder(ones, d[4], d[5])
        ones, b = full_adder(ones, d[6], d[7])
        twos, f = full_adder(twos, a, b)
        fours, carry = full_adder(count[2], e, f)
        count[:3] = ones, twos, fours
        for k in range(3, len(count)):
            count[k], carry = count[k] ^ carry, count[k] & carry
        over |= carry
        over |= over_radius(count, radius)
        left = over != FULL
        if not left.all():
            query, word, over, count = query[left], word[left], over[left], [c[left] for c in count]
        if not len(query):
            break
    return query, word, ~over


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i]; afterwards every label is the least index of its set."""
    while len(a):
        a, b = label[a], label[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label[:] = further


def close_pairs(prints: np.ndarray, sizes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows a < b of fingerprints within the radius, in runs of these sizes."""
    n = len(prints)
    if not n:
        return
    bits = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little")
    padded = np.zeros((-(-n // 64) * 64, bits.shape[1]), np.uint8)
    padded[:n] = bits
    planes = np.ascontiguousarray(np.packbits(padded.T, axis=1, bitorder="little")).view(np.uint64)
    end = np.repeat(np.cumsum(sizes), sizes)
    row = np.arange(n)
    words = (end - 1) // 64 - row // 64 + 1
    before = np.cumsum(words) - words
    total = int(words.sum())
    one = np.uint64(1)
    for at in range(0, total, PAIRS):
        pair = np.arange(at, min(total, at + PAIRS))
        query = np.searchsorted(before, pair, side="right") - 1
        word = query // 64 + pair - before[query]
        low = np.clip(query + 1 - 64 * word, 0, 64).astype(np.uint64)
        high = np.clip(end[query] - 64 * word, 0, 64).astype(np.uint64)
        up_to = lambda k: np.where(k == 64, FULL, (one << (k & np.uint64(63))) - one)
        lanes = up_to(high) & ~up_to(low)
        some = lanes != 0
        query, word, close = close_lanes(planes, bits, query[some], word[some], lanes[some], radius)
        for k in range(64):
            hit = (close >> np.uint64(k)) & one != 0
            if hit.any():
                yield query[hit], word[hit] * 64 + k


Found = Iterator[tuple[np.ndarray, np.ndarray]]


def forest(nodes: np.ndarray, prints: np.ndarray, sizes: np.ndarray, radius: int) -> Found:
    """Links within runs of fingerprints (rows), as (node, least-placed node it reaches in its run)."""
    label = np.arange(len(prints))
    for a, b in close_pairs(prints, sizes, radius):
        unite(label, a, b)
    far = label != np.arange(len(prints))
    yield nodes[far, 0], nodes[label[far], 0]


def compare_buckets(radius: int, words: int, find: Callable, carried: int):
    first = 3 + carried

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (bucket, i, j, carried, words) come sorted by bucket; a bucket that a batch cuts waits for its rest."""
        held = np.empty((0, first + words), np.int64)

        def links(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            key = rows[:, :3]
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            sizes = np.append(starts[1:], len(rows)) - starts
            rows = rows[np.repeat(sizes > 1, sizes)]
            prints = np.ascontiguousarray(rows[:, first:]).view(np.uint64)
            for a, b in find(rows[:, 3:first], prints, sizes[sizes > 1], radius):
                if len(a):
                    yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(first + words)]
            held = np.concatenate([held, np.stack(columns, axis=1)])
            other = np.flatnonzero((held[:, :3] != held[-1:, :3]).any(axis=1))
            if len(other):
                yield from links(held[:other[-1] + 1])
                held = held[other[-1] + 1:]
        if len(held):
            yield from links(held)

    return compare


def untouched_keys(word: Column, radius: int, blocks: int) -> list[Column]:
    """One key per choice of ``blocks - radius`` runs of bits of a word: two words within the radius share one of them."""
    if blocks <= radius:
        raise ValueError("more blocks than differing bits are needed")
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), word.bitwiseAND(F.lit(signed).cast("bigint"))))
    return keys


def banded_keys(words: Column, tables: int) -> list[Column]:
    """One key per 16 bits of a wide fingerprint."""
    bits = lambda t: F.shiftrightunsigned(F.get(words, t // 4), t % 4 * 16).bitwiseAND(F.lit(0xFFFF).cast("bigint"))
    return [bits(t) + F.lit(t << 16).cast("bigint") for t in range(tables)]


def links_of(distinct: DataFrame, keys: list[Column], radius: int, words: int = 1, part: int = BUCKET_PART) -> DataFrame:
    """Links (a, b) between nodes of rows (node, print) that share a key and are within the radius on the first ``words``
    words: not every pair of a dense bucket, but what connects as much."""
    names, carried = [f"w{k}" for k in range(words)], ["node"]
    values = [F.get("print", k).alias(name) for k, name in enumerate(names)]
    spread = distinct.select(*carried, *values, F.explode(F.array(*keys)).alias("bucket"))
    large = spread.groupBy("bucket").count().where(F.col("count") > part)
    large = large.select("bucket", F.ceil(F.col("count") / part).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    units = F.when(F.col("parts").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))
    )
    dealt = spread.join(large, "bucket", "left").select("bucket", F.explode(units).alias("u"), *carried, *names)
    ordered = dealt.select("bucket", "u.i", "u.j", *carried, *names).repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    return ordered.mapInArrow(compare_buckets(radius, words, forest, len(carried)), "a bigint, b bigint")


def with_roots(distinct: DataFrame, links: DataFrame) -> DataFrame:
    """The rows with ``root``, the least node of their component."""
    roots = star_forest(links)
    return distinct.join(roots, distinct["node"] == roots["node"], "left").select(distinct["*"], F.coalesce("root", distinct["node"]).alias("root"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id, the least doc_id reachable over links."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.get(fingerprints(F.col("text"), width), 0).alias("node"))
    prints = materialize(rows, "simhash")
    distinct = prints.groupBy("node").agg(F.min("doc_id").alias("least"))
    distinct = materialize(distinct.select("node", "least", F.array("node").alias("print")), "fingerprints")
    member = with_roots(distinct, links_of(distinct, untouched_keys(F.col("node"), radius, blocks), radius))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    found = prints.join(member.join(least, "root").select("node", "component_id"), "node")
    return found.select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = SIMILAR_WIDTH, similarity: float = SIMILARITY, tables: int = TABLES, compared: int = COMPARED) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the least doc_id stays (a null counts
    as the largest; of repeated rows, any one). Links are pairs whose sets of shingles have at least the similarity."""
    rows = keyed(docs)
    prints = materialize(rows.select(*KEY, set_prints(F.col("_text"), width, compared, tables).alias("print")), "simhash")
    distinct = prints.groupBy("print").agg(F.min(F.struct(*KEY)).alias("first")).withColumn("node", F.monotonically_increasing_id())
    distinct = materialize(distinct, "fingerprints")
    keys = [F.get("print", compared + t) for t in range(tables)]
    radius = expected_radius(similarity, 64 * compared)
    near = materialize(links_of(distinct, keys, radius, compared), "candidates")
    involved = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = distinct.join(involved, "node").select("node", "first.*")
    texts = rows.select(*KEY, "_text").join(wanted, KEY).dropDuplicates(["node"])
    sets = texts.select("node", shingle_chunks(F.col("_text"), width).alias("chunks"))
    sets = materialize(sets.withColumn("size", chunked_size("chunks")), "shingles")
    links = linked(sets, near, sets, round(100 * similarity))
    kept = with_roots(distinct.select("node", "first"), links).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    return rows.select("_row", *KEY).join(kept, KEY, "left_semi").dropDuplicates(KEY).select("_row.*")
