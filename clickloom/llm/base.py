"""What the operators share: row keys, written tables, text buffers and connected components.

Conventions of all operators: a null text is an empty text, columns besides those an operator reads are carried
inside one struct (so that their names cannot clash), and rows equal in ``doc_id`` and ``text`` get equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.session import materialize

KEY = ["_id", "_h"]
SEED = 42


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def text_of(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def keyed(docs: DataFrame) -> DataFrame:
    """The rows as ``_row``, with the key (``_id``, ``_h``) that tells texts and documents apart; rows without id sort last."""
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    identity, text = F.col("_row.doc_id").cast("bigint"), F.col("_row.text")
    return packed.select(
        "_row",
        F.coalesce(identity, F.lit((1 << 63) - 1)).alias("_id"),
        F.xxhash64(identity, F.isnull(identity), text, F.isnull(text)).alias("_h"),
        text_of(text).alias("_text"),
    )


def raw_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes, nulls as empty ones."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def shingles(raw: bytes, width: int) -> np.ndarray:
    """The hashes of a text's shingles, as often as they occur."""
    tokens = raw.lower().split()      # ASCII letters and ASCII white space only, since these are bytes
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= width:
        starts, ends = [0], [len(joined)]
    else:
        after = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
        ends = (after[width - 1:] - 1).tolist()
        starts = [0, *after[:len(ends) - 1].tolist()]
    of = xxhash.xxh64_intdigest
    return np.fromiter((of(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(ends))


def lists(found: list[np.ndarray]) -> pa.Array:
    """Arrays of words as an Arrow column."""
    offsets = np.cumsum([0, *map(len, found)])
    flat = np.concatenate(found) if found else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64)))


def star_forest(edges: DataFrame) -> DataFrame:
    """Connected components of the links (a, b): rows (node, root), root the least node, for all nodes but the roots.

    Alternating large-star and small-star steps: every step is a grouped minimum and an equi-join on the links, whose
    number never grows, and the rounds are logarithmic. Each round is a written table, so a lost executor costs a task.
    """

    def smaller_first(df: DataFrame, a: str, b: str) -> DataFrame:
        return df.where(f"{a} <> {b}").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    links = materialize(smaller_first(edges, "a", "b"), "links")
    seen = digest(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = smaller_first(both.where("b > a").join(least, "a").select("b", "m"), "b", "m")
        large = materialize(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a")
        links = materialize(smaller_first(hung.select("b", "m").union(least.select("a", "m")), "b", "m"), "small-star")
        now = digest(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
