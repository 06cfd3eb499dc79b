"""Removal of long byte strings that occur more than once, over a logarithmic family of sampled suffix arrays.

A string of ``length`` bytes is repeated if it also starts anywhere else. Not every suffix is indexed: each string has an
anchor, the place of its least 8-byte hash among those that leave room for ``GRAM`` bytes, which depends on its bytes
alone, so equal strings have equal anchors and only suffixes at anchors are needed, one in about a hundred and seventy.
A suffix is ordered by the hash of its first ``GRAM`` bytes; that order serves as well as the alphabet's, since only
equality at a fixed length counts. An index level is the sorted array of a set of suffixes, with the number of suffixes
and the least and greatest context (the bytes of all strings that an anchor stands for) per entry. Every batch of
documents becomes a level, and while the last two levels are of equal rank they are merged, so n batches leave at most
log2(n) + 1 levels, each suffix having been rewritten as often. New batches are not scanned against the levels: once all
are in, what the levels still hold apart is grouped by hash, and entries of more than one suffix are those that occur again.
With ``BATCHES`` a power of two, one level is left and holds them already.

Their contexts settle the rest: equal contexts mean that every string of the anchor is repeated. Where a suffix occurs in
different contexts, one representative for each set of equal contexts is compared further, ``PIECE`` strings at a time:
the bytes they have in common, by hash, and the bytes to the left and right of those, as they are. If the common bytes
occur once, none of the strings is repeated; if the edges are equal too, all are; else each string is told by its share
of the edges. All grouping is pre-aggregated, so a passage that a third of the documents share is one entry.

Texts are kept in compressed chunks of bounded size, which is what travels to the tasks that cut them.

Defined results: a null text is an empty one; texts shorter than ``length`` stay whole; a repeated row is a copy, so all
its strings are repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.base import raw_texts
from clickloom.session import discard, materialize, noted

LENGTH, GRAM = 400, 64
PIECE = 32               # neighbouring strings that are compared together
CHUNK_BYTES = 1 << 24
BATCHES = 4
SEGMENT = 1 << 22        # strings of a text that are anchored at once
ONE, TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
LOW = np.uint64(0xFFFFFFFF)


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``length`` bytes: places, and first and last start of the strings they stand for."""
    found = [_anchors(text, at, min(at + SEGMENT, len(text) - length + 1), length, gram) for at in range(0, len(text) - length + 1, SEGMENT)]
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchors(text: bytes, first: int, last: int, length: int, gram: int):
    """The same for strings that start at first, ..., last - 1."""
    width = length - gram + 1
    n = last - first + width - 1
    hashes = np.ndarray((n,), "<u8", text, first, (1,)) * ONE
    hashes = (hashes ^ (hashes >> np.uint64(31))) * TWO
    placed = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    placed[:n] = (hashes & ~LOW) | np.arange(n, dtype=np.uint64)
    blocks = placed.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[:last - first]
    behind = np.minimum.accumulate(blocks, axis=1).ravel()[width - 1:width - 1 + last - first]
    least = (np.minimum(ahead, behind) & LOW).astype(np.int64)
    low = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    high = np.r_[low[1:], len(least)] - 1
    return least[low] + first, low + first, high + first


def as_long(hashes: list[int]) -> np.ndarray:
    return np.array(hashes, np.uint64).view(np.int64)


def chunked(chunk_bytes: int, length: int):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (doc_id, text) to one row per chunk, with the anchors of all texts at their places in the chunk."""
        part, number = TaskContext.get().partitionId(), 0
        pack, of = zstandard.ZstdCompressor(level=3), xxhash.xxh64_intdigest
        doc_ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            grams, contexts, sizes, shifts = [], [], [], []
            for text in texts:
                place, low, high = anchors(text, length)
                grams += [of(text[a:a + GRAM]) for a in place.tolist()]
                contexts += [of(text[a:b]) for a, b in zip(low.tolist(), (high + length).tolist())]
                sizes.append(high - low + 1)
                shifts.append(place - low)
            return pa.record_batch([
                pa.array([part << 32 | number]), pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([np.array([len(t) for t in texts], "<i8").tobytes()]), pa.array([pack.compress(b"".join(texts))], pa.binary()),
                pa.array([as_long(grams)], pa.list_(pa.int64())), pa.array([as_long(contexts)], pa.list_(pa.int64())),
                *[pa.array([np.concatenate(x).astype("<u2").tobytes()]) for x in (sizes, shifts)],
            ], names=["chunk", "doc_ids", "lens", "blob", "grams", "contexts", "sizes", "shifts"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                if size and size + len(text) > chunk_bytes:
                    yield row()
                    doc_ids, texts, size, number = [], [], 0, number + 1
                doc_ids.append(doc_id)
                texts.append(text)
                size += len(text) + 1
        if texts:
            yield row()

    return chunks


CHUNK = ("chunk bigint, doc_ids array<bigint>, lens binary, blob binary, grams array<bigint>, contexts array<bigint>, "
         "sizes binary, shifts binary")


def least_and_greatest(entries: DataFrame) -> DataFrame:
    """Per gram the number of suffixes and the least and greatest context; ``high`` is null where there is but one."""
    merged = entries.groupBy("gram").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max(F.coalesce("high", "low")).alias("high"))
    return merged.withColumn("high", F.nullif("high", "low"))


class SuffixFamily:
    """The index: sorted levels whose ranks decrease; a level of rank r holds 2**r batches."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []
        self.paths: list[list[str]] = []         # where each level is written

    def _write(self, entries: DataFrame, rank: int) -> None:
        paths: list[str] = []
        with noted(paths):
            level = materialize(least_and_greatest(entries).sortWithinPartitions("gram"), "suffixes")
        self.levels.append((rank, level))
        self.paths.append(paths)

    def _delete(self, paths: list[list[str]]) -> None:
        for path in sum(paths, []):
            discard(path)

    def add(self, suffixes: DataFrame) -> None:
        """Index the suffixes (gram, context) of a new batch; levels that were merged are deleted."""
        self._write(suffixes.select("gram", F.lit(1).cast("bigint").alias("n"), F.col("context").alias("low"), F.lit(None).cast("bigint").alias("high")), 0)
        while len(self.levels) > 1 and self.levels[-2][0] == self.levels[-1][0]:
            (rank, one), (_, two) = self.levels[-2:]
            old, self.paths = self.paths[-2:], self.paths[:-2]
            self.levels = self.levels[:-2]
            self._write(one.unionByName(two), rank + 1)
            self._delete(old)

    def repeated(self) -> DataFrame:
        """(gram, mixed): the suffixes that occur more than once, and whether in different contexts."""
        merged = self.levels[0][1]
        if len(self.levels) > 1:
            for _, level in self.levels[1:]:
                merged = merged.unionByName(level)
            merged = least_and_greatest(merged)
        return merged.where("n > 1").select("gram", F.col("high").isNotNull().alias("mixed"))

    def clear(self) -> None:
        self._delete(self.paths)
        self.levels, self.paths = [], []


def unpacked(batch: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(name)[0].as_py(), kind)


def layout(row: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of a chunk's anchors, and the first and last starts of their strings.

    Anchors are kept as the number of their strings and the distance to the first one: the strings of a text follow
    each other without a gap, so their starts need not be stored.
    """
    lens, sizes, shifts = unpacked(row, "lens", "<i8"), unpacked(row, "sizes", "<u2").astype(np.int64), unpacked(row, "shifts", "<u2")
    strings = np.cumsum(np.maximum(lens - length + 1, 0))
    first = np.cumsum(sizes) - sizes                     # counted over the strings of the chunk
    document = np.searchsorted(strings, first, side="right")
    before = np.r_[0, strings][document]
    lows = first - before + (np.cumsum(lens) - lens)[document]
    return lows + shifts, lows, lows + sizes - 1


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(len(batch)):
            yield batch.slice(k, 1)


def marked(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Anchor numbers and states of a chunk."""
    marks = row.column("marks")[0].values
    return (marks.field("k").to_numpy(), marks.field("state").to_numpy()) if marks is not None else (np.empty(0, np.int64),) * 2


REPEATED, OPEN, SAMPLE = 1, 2, 4     # all strings are repeated; to be compared; to be compared with


def pieces_of(length: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The strings of anchors that are to be compared, ``PIECE`` starts at a time.

        A piece is (gram, its number from the anchor, hash of the common bytes, bytes to their left and right, chunk, place of the
        common bytes, open). At the ends of a document the edges are shorter.
        """
        of, unpack, edge = xxhash.xxh64_intdigest, zstandard.ZstdDecompressor(), PIECE - 1
        for row in rows_of(batches):
            number, state = marked(row)
            number, state = number[state >= OPEN], state[state >= OPEN]
            if not len(number):
                continue
            text = unpack.decompress(row.column("blob")[0].as_py())
            place, low, high = (x[number] for x in layout(row, length))
            grams, chunk = row.column("grams")[0].values.to_numpy()[number], row.column("chunk")[0].as_py()
            ends = np.cumsum(unpacked(row, "lens", "<i8"))
            document = np.searchsorted(ends, place, side="right")
            first, last = (place - high) // PIECE, (place - low) // PIECE
            for a in range(0, len(number), 4096):
                part = slice(a, a + 4096)
                counts = last[part] - first[part] + 1
                j = np.repeat(first[part] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                at = np.repeat(place[part], counts) - PIECE * j
                stop = np.repeat(ends[document[part]], counts)
                start = np.repeat(ends[document[part]] - unpacked(row, "lens", "<i8")[document[part]], counts)
                cores, lefts, rights = [], [], []
                for p, begin, end in zip(at.tolist(), start.tolist(), stop.tolist()):
                    cores.append(of(text[p:p + length - edge]))
                    lefts.append(text[max(begin, p - edge):p])
                    rights.append(text[p + length - edge:min(end, p + length)])
                yield pa.record_batch([
                    pa.array(np.repeat(grams[part], counts)), pa.array(j.astype(np.int32)), pa.array(as_long(cores)), pa.array(lefts, pa.binary()),
                    pa.array(rights, pa.binary()), pa.array(np.full(len(at), chunk)), pa.array(at), pa.array(np.repeat(state[part] == OPEN, counts)),
                ], names=["gram", "j", "core", "left", "right", "chunk", "at", "open"])

    return pieces


def repeated_starts(pieces: DataFrame) -> DataFrame:
    """(chunk, low, high): ranges of starts of repeated strings in open pieces."""
    core = ["gram", "j", "core"]
    low, high = F.col("at") - F.octet_length("left"), F.col("at") - (PIECE - 1) + F.octet_length("right")
    variants = pieces.groupBy(*core, "left", "right").agg(F.count("*").alias("n"), F.min(F.struct("chunk", "at")).alias("place"), F.max("open").alias("open"))
    variants = materialize(variants, "variants")
    shared = variants.groupBy(*core).agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    mixed = materialize(shared.where("kinds > 1").select(*core), "mixed-cores")

    equal = variants.where("n > 1 AND open").select(*core, "left", "right")
    whole = pieces.where("open").join(equal, [*core, "left", "right"], "left_semi").select("chunk", low.alias("low"), high.alias("high"))

    # The string that starts k bytes before the common bytes has k bytes of the left edge and the rest of the right one.
    open_, k = variants.join(mixed, core), F.col("k")
    least, most = F.lit(PIECE - 1) - F.octet_length("right"), F.octet_length("left")
    each = open_.where(least <= most).withColumn("k", F.explode(F.sequence(least, most)))
    edges = F.xxhash64(F.expr("substring(left, octet_length(left) - k + 1, k)"), F.expr(f"substring(right, 1, {PIECE - 1} - k)"))
    each = each.select(*core, "k", edges.alias("edges"), "n", "open", (F.col("place.at") - k).alias("start"), F.col("place.chunk").alias("chunk"))
    each = materialize(each, "strings")
    again = materialize(each.groupBy(*core, "k", "edges").agg(F.sum("n").alias("total")).where("total > 1").drop("total"), "repeated-strings")
    single = each.where("open AND n = 1").join(again, [*core, "k", "edges"], "left_semi")
    return whole.unionByName(single.select("chunk", F.col("start").alias("low"), F.col("start").alias("high")))


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of intervals that overlap or touch."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.r_[True, starts[1:] > reach[:-1]]
    return starts[fresh], reach[np.r_[np.flatnonzero(fresh)[1:] - 1, len(reach) - 1]]


def spans_by_document(row: pa.RecordBatch, length: int) -> Iterator[tuple[int | None, bytes, np.ndarray, np.ndarray]]:
    """Per document of a chunk: doc_id, text, and starts and ends of the removed runs."""
    number, state = marked(row)
    number = number[state & REPEATED > 0]
    _, lows, highs = layout(row, length)
    lows, highs = lows[number], highs[number]
    ranges = row.column("starts")[0].values
    first, last = (ranges.field(k).to_numpy() for k in ("low", "high")) if ranges is not None else (lows[:0], lows[:0])
    starts, ends = np.r_[lows, first], np.r_[highs, last] + length
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    text = zstandard.ZstdDecompressor().decompress(row.column("blob")[0].as_py())
    base = 0
    for doc_id, n in zip(row.column("doc_ids")[0].as_py(), unpacked(row, "lens", "<i8").tolist()):
        a, b = np.searchsorted(starts, [base, base + n])
        low, high = merged_spans(starts[a:b] - base, ends[a:b] - base) if b > a else (starts[:0], starts[:0])
        yield doc_id, text[base:base + n], low, high
        base += n


def kept_bytes(text: bytes, low: np.ndarray, high: np.ndarray) -> bytes:
    if not len(low):
        return text
    return b"".join(text[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), len(text)]))


def digests(length: int):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            found = [(d, len(t), int((high - low).sum()), len(low), hashlib.sha256(kept_bytes(t, low, high)).hexdigest())
                     for d, t, low, high in spans_by_document(row, length)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*found), kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return digest


def kept_texts(length: int):
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            found = [(d, kept_bytes(t, low, high), [[int(a), int(b)] for a, b in zip(low, high)])
                     for d, t, low, high in spans_by_document(row, length)]
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.list_(pa.int64()))]
            yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*found), kinds)], names=["doc_id", "kept", "spans"])

    return texts


def settled(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunks of all texts with the states of their anchors and the starts of further repeated strings."""
    if not GRAM + 8 <= length < 1 << 16:
        raise ValueError(f"strings of {GRAM + 8} to 65,535 bytes are needed")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    chunks = materialize(rows.mapInArrow(chunked(chunk_bytes, length), CHUNK), "text-chunks")
    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("grams", "contexts")).alias("k", "x"))
    listed = listed.select("chunk", "k", F.col("x.grams").alias("gram"), F.col("x.contexts").alias("context"))

    family = SuffixFamily()
    for batch in range(batches):
        family.add(listed.where(F.pmod(F.xxhash64("chunk"), F.lit(batches)) == batch).select("gram", "context"))
    done: list[str] = []
    with noted(done):
        again = materialize(family.repeated(), "repeated-suffixes")
        family.clear()
        places = materialize(listed.join(again, "gram"), "repeated-places")
    several = places.where("mixed")
    contexts = several.groupBy("gram", "context").agg(F.count("*").alias("copies"), F.min(F.struct("chunk", "k")).alias("first"))
    with noted(done):
        contexts = materialize(contexts, "contexts")
    one_of = (F.col("first.chunk") == F.col("chunk")) & (F.col("first.k") == F.col("k"))
    state = F.when(F.col("copies") == 1, OPEN).otherwise(F.when(one_of, REPEATED + SAMPLE).otherwise(REPEATED))
    states = several.join(contexts, ["gram", "context"]).select("chunk", "k", state.alias("state"))
    states = states.unionByName(places.where("NOT mixed").select("chunk", "k", F.lit(REPEATED).alias("state")))
    marks = states.groupBy("chunk").agg(F.collect_list(F.struct("k", "state")).alias("marks"))      # bounded by the chunk
    marks = materialize(marks, "marks")
    for path in done:
        discard(path)

    known = chunks.drop("doc_ids", "contexts").join(marks, "chunk")
    pieces = known.mapInArrow(pieces_of(length), "gram bigint, j int, core bigint, left binary, right binary, chunk bigint, at bigint, open boolean")
    starts = repeated_starts(materialize(pieces, "pieces"))
    starts = starts.groupBy("chunk").agg(F.collect_list(F.struct("low", "high")).alias("starts"))   # bounded by the chunk
    return chunks.drop("grams", "contexts").join(marks, "chunk", "left").join(starts, "chunk", "left")


def repeated_bytes(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (removed runs) and the sha256 of the bytes that stay."""
    return settled(docs, length, batches, chunk_bytes).mapInArrow(
        digests(length), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: doc_id, the bytes that stay (cuts may fall within a character) and the removed runs."""
    return settled(docs, length, batches, chunk_bytes).mapInArrow(kept_texts(length), "doc_id bigint, kept binary, spans array<array<bigint>>")
