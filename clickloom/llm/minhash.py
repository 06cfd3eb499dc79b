"""MinHash near-duplicates by fast similarity sketching: bins filled in rounds, bands, exact sets.

A sketch has ``SKETCH`` coordinates. In round r, each member of a set is thrown into one coordinate by a hash of its own and
leaves the value (r, hash) there if that is smaller; after the first round that leaves no coordinate empty, the sketch is
done. Large sets need one round. From round ``SKETCH`` on, all members are thrown into coordinate r - ``SKETCH``, so every
coordinate is full after at most 2 * ``SKETCH`` rounds, even of a single member. Coordinates of two sets agree with the
chance of their similarity and as closely around it as independent ones, at the cost of a hash or so per member.

``BANDS`` bands of ``ROWS`` coordinates key the candidates: two sets at 0.8 share no key in 8 of a million cases. Whoever
shares a key with others is a candidate together with the least of them, one row per text and key, and ``similar.linked``
decides on full sets.

Defined results: texts without words have no shingles, their own component and links to nothing; a component without any
doc_id has a null component_id and is kept; repeated rows are rows like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.base import KEY, keyed, lists, raw_texts, shingles
from clickloom.llm.similar import chunked_size, linked, rooted, shingle_chunks
from clickloom.session import materialize

WIDTH, PERCENT = 2, 80
BANDS, ROWS = 64, 8
SKETCH = BANDS * ROWS
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
THROWS = 1 << 13        # hashes that are made at once
SALTS = np.array([xxhash.xxh64_intdigest(b"round %d" % r) | 1 for r in range(2 * SKETCH)], np.uint64)


def thrown(members: np.ndarray, rounds: np.ndarray) -> np.ndarray:
    """A hash per round (row) and member."""
    mixed = (members ^ rounds[:, None]) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * rounds[:, None]
    return mixed ^ (mixed >> np.uint64(29))


def sketch(members: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """The sketch of a set of 64-bit hashes; a set without members has an empty one."""
    bins = np.full(size, EMPTY)
    if not len(members):
        return bins
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    step = max(1, THROWS // len(members))
    for first in range(0, size, step):
        rounds = np.arange(first, min(size, first + step), dtype=np.uint64)
        hashes = thrown(members, SALTS[first:first + len(rounds)])
        place = ((hashes >> half) * np.uint64(size)) >> half
        np.minimum.at(bins, place.ravel().astype(np.int64), ((rounds[:, None] << half) | (hashes & low)).ravel())
        if (bins != EMPTY).all():
            return bins
    left = np.flatnonzero(bins == EMPTY)
    for k in range(0, len(left), step):
        at = left[k:k + step]
        least = (thrown(members, SALTS[size + at]) & low).min(axis=1)
        bins[at] = ((at + size).astype(np.uint64) << half) | least
    return bins


def band_keys(coordinates: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key per band, of all its coordinates."""
    rows = len(coordinates) // bands
    mixed = (coordinates ^ (coordinates >> np.uint64(31))) * SALTS[:len(coordinates)]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * SALTS[len(coordinates):2 * len(coordinates)]
    return mixed.reshape(bands, rows).sum(axis=1, dtype=np.uint64)


def set_record(raw: bytes, width: int, bands: int) -> np.ndarray:
    """Of a text: the number of its shingles, two words that identify the set, and the keys."""
    members = np.unique(shingles(raw, width))
    identity = np.frombuffer(xxhash.xxh3_128_digest(members.tobytes()), np.uint64)
    keys = band_keys(sketch(members), bands) if len(members) else np.empty(0, np.uint64)
    return np.concatenate([np.array([len(members)], np.uint64), identity, keys])


def set_records(text: Column, width: int = WIDTH, bands: int = BANDS) -> Column:
    @F.arrow_udf("array<bigint>")
    def compute(texts: pa.Array) -> pa.Array:
        return lists([set_record(x, width, bands) for x in raw_texts(texts)])

    return compute(text)


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id reachable over links) and kept (it is its own)."""
    texts = keyed(docs)
    record = set_records(F.col("_text"), width, bands)
    rows = materialize(texts.select(F.col("_row.doc_id").cast("bigint").alias("doc_id"), *KEY, record.alias("_r")), "sketches")
    rows = rows.select("doc_id", *KEY, F.get("_r", 0).alias("n_shingles"), F.struct(F.get("_r", 1).alias("x"), F.get("_r", 2).alias("y")).alias("set"), "_r")
    sets = rows.where("n_shingles > 0").groupBy("set").agg(
        F.min("doc_id").alias("least"), F.min(F.struct(*KEY)).alias("first"), F.any_value("_r").alias("_r"),
    )
    sets = sets.select(F.monotonically_increasing_id().alias("node"), "set", "least", "first", F.slice("_r", 4, bands).alias("keys"))
    sets = materialize(sets, "sets")

    spread = sets.select("node", F.posexplode("keys").alias("band", "key"))
    leaders = spread.groupBy("band", "key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    candidates = spread.join(leaders, ["band", "key"]).where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    candidates = materialize(candidates, "candidates")
    involved = candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = sets.join(involved, "node").select("node", "first.*")
    full = texts.select(*KEY, "_text").join(wanted, KEY).dropDuplicates(["node"]).select("node", shingle_chunks(F.col("_text"), width).alias("chunks"))
    full = materialize(full.withColumn("size", chunked_size("chunks")), "shingles")

    member = rooted(sets.select("node", "set", "least"), linked(full, candidates, full, percent))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    component = member.join(least, "root").select("set", "component_id")
    found = rows.select("doc_id", "n_shingles", "set").join(component, "set", "left")
    found = found.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
