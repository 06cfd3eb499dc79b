"""Removal of repeated runs of lines, by content-defined chunks.

A line closes a chunk when a rolling hash over the hashes of the last ``WINDOW`` lines is divisible by ``DIVISOR`` (and
the chunk has ``LEAST`` lines), or at ``MOST`` lines. Boundaries depend on nearby lines alone, so after an insertion the
old ones return and copies of a passage have equal chunks wherever it stands. Chunks whose hash occurs at several places
are compared with the first of them (least doc_id, then place) by the SHA-256 of their bytes; equal ones are removed, whole
lines at a time. Only chunks with at least two lines that hold more than white space count. Texts travel once, to be cut.

Defined results: a null text stays null; the first place of a chunk always stays; a chunk that differs from the first
one of its hash stays; repeated rows are one document with one result; rows without doc_id come last; extra columns are
carried along; an empty table stays empty.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from clickloom.llm.base import KEY, keyed, raw_texts
from clickloom.session import materialize

WINDOW, DIVISOR, LEAST, MOST = 2, 3, 2, 12
MASK = (1 << 64) - 1


def boundaries(hashes: list[int]) -> list[int]:
    """Ends of the chunks of lines with these hashes."""
    ends, begin, rolling = [], 0, 0
    for i, h in enumerate(hashes):
        rolling = (rolling << 1 | rolling >> 63) & MASK ^ h
        if i >= WINDOW:
            old = hashes[i - WINDOW]
            rolling ^= (old << WINDOW | old >> (64 - WINDOW)) & MASK
        size = i + 1 - begin
        if size >= MOST or (size >= LEAST and rolling % DIVISOR == 0):
            ends.append(i + 1)
            begin = i + 1
    if begin < len(hashes):
        ends.append(len(hashes))
    return ends


def chunks_of(raw: bytes) -> list[tuple[int, int, int]]:
    """(first line, lines, hash) of the chunks that count."""
    lines, of = raw.split(b"\n"), xxhash.xxh64_intdigest
    found, begin = [], 0
    for end in boundaries([of(line) for line in lines]):
        part = lines[begin:end]
        if sum(1 for line in part if line.strip()) > 1:
            h = of(b"\n".join(part))
            found.append((begin, end - begin, h - (1 << 64) if h >> 63 else h))
        begin = end
    return found


PIECES = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("hash", pa.int64())]))


@F.arrow_udf(T.ArrayType(T.StructType().add("at", "integer").add("n", "integer").add("hash", "long")))
def line_chunks(texts: pa.Array) -> pa.Array:
    return pa.array([[dict(zip(("at", "n", "hash"), c)) for c in chunks_of(raw)] for raw in raw_texts(texts)], PIECES)


SEALED = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("hash", pa.int64()), ("digest", pa.binary())]))


@F.arrow_udf(T.ArrayType(T.StructType().add("at", "integer").add("n", "integer").add("hash", "long").add("digest", "binary")))
def sealed(texts: pa.Array, pieces: pa.Array) -> pa.Array:
    """The pieces with the SHA-256 of their bytes."""
    out = []
    for raw, found in zip(raw_texts(texts), pieces.to_pylist()):
        lines = raw.split(b"\n")
        out.append([p | {"digest": hashlib.sha256(b"\n".join(lines[p["at"]:p["at"] + p["n"]])).digest()} for p in found])
    return pa.array(out, SEALED)


@F.arrow_udf(T.StructType().add("text", "string").add("removed", "integer").add("lines", "integer"))
def without_pieces(texts: pa.Array, pieces: pa.Array) -> pa.Array:
    """The text without the lines of these pieces."""
    left, removed, total = [], [], []
    for text, marked in zip(texts.cast(pa.binary()).to_pylist(), pieces.to_pylist()):
        lines, gone = ([] if text is None else text.split(b"\n")), set()
        for piece in marked or ():
            gone.update(range(piece["at"], piece["at"] + piece["n"]))
        left.append(None if text is None else b"\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text)
        removed.append(len(gone))
        total.append(len(lines))
    return pa.StructArray.from_arrays(
        [pa.array(left, pa.binary()).cast(pa.string()), pa.array(removed, pa.int32()), pa.array(total, pa.int32())],
        names=["text", "removed", "lines"],
    )


def cut(docs: DataFrame) -> DataFrame:
    """The rows as ``_row`` with ``cut``: the text that stays, the number of removed lines and of all lines."""
    rows = keyed(docs)
    pieces = rows.select(*KEY, F.explode(sealed(F.col("_text"), line_chunks("_text"))).alias("p")).select(*KEY, "p.*")
    pieces = materialize(pieces, "line-chunks")
    place = F.struct(*KEY, "at", "n")
    firsts = pieces.groupBy("hash").agg(F.min(F.struct(*KEY, "at", "n", "digest")).alias("first"), F.max(place).alias("last"))
    firsts = firsts.withColumn("place", F.struct(*[f"first.{c}" for c in (*KEY, "at", "n")]))
    firsts = materialize(firsts.where("place <> last").select("hash", "place", F.col("first.digest").alias("of_first")), "first-places")
    copies = pieces.join(firsts, "hash").where((place != F.col("place")) & (F.col("digest") == F.col("of_first")))
    marks = copies.groupBy(*KEY).agg(F.collect_list(F.struct("at", "n")).alias("pieces"))
    # Marks grow with the texts: one plan for all sizes.
    return rows.select("_row", *KEY).join(marks.hint("merge"), KEY, "left").select("_row", without_pieces(F.col("_row.text"), F.col("pieces")).alias("cut"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, its lines, the removed ones, and the sha256 of the text that stays."""
    return cut(docs).select(
        F.col("_row.doc_id").cast("bigint").alias("doc_id"), F.col("cut.lines").cast("bigint").alias("n_lines"),
        F.col("cut.removed").cast("bigint").alias("n_removed_lines"), F.sha2(F.col("cut.text"), 256).alias("kept_sha256"),
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with the texts that stay, and ``n_chars`` following them where it is a column."""
    changed = F.col("cut.removed") > 0
    given = {f.name: f.dataType for f in docs.schema}
    new = {"text": F.col("cut.text").cast(given["text"])}
    if "n_chars" in given:
        new["n_chars"] = F.when(changed, F.char_length("cut.text")).otherwise(F.col("_row.n_chars")).cast(given["n_chars"])
    return cut(docs).select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
