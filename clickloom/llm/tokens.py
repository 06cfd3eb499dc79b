"""Token ids in binary shard files, with document boundaries as Elias-Fano sequences.

Documents are dealt by range of doc_id and written in ascending order, several bounded shards per task. A shard file is

    magic "EFID", id width (u16), low bits (u16), documents (u64), ids (u64)
    doc_id as i64 each, then a bit per document that is set where the doc_id is null
    low bits of the documents + 1 boundaries, packed
    high bits of the boundaries in unary (u64 words), then every 256th one's place (u32)
    the ids, little-endian

so that a boundary costs about 2 + log2(mean length) bits and any of them is found by a select on the unary bits. Files
get names of their own for each attempt; the written manifest of finished tasks says which belong to the data set.

Defined results: a null text is an empty one (only the end id is written); null doc_ids come first; rows with equal
doc_id are ordered by a hash of their text; an empty table gives an empty data set.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from clickloom.llm.base import text_of
from clickloom.session import materialize, new_path

END = 2
SHARD_IDS = 1 << 22
HEAD = struct.Struct("<4sHHQQ")
MAGIC, SAMPLE = b"EFID", 256
KNOWN_UNITS = 1 << 20     # units a worker remembers before it starts anew

# A byte-level tokenizer cuts texts by pattern before it encodes the parts. It surely cuts between a letter and what is
# none, between marks and letters, around single line ends, and before a space and a letter, but for apostrophes and
# letters unknown here. Units end at such places alone: words, marks, line ends, and all else up to a space and a letter.
LETTER, MARK = "A-Za-zÀ-ÖØ-öø-ɏ", ".,;:!?|"
UNIT = re.compile(
    f" ?[{LETTER}]++(?=[ \\n{MARK}]|\\Z)|[{MARK}]++\\n?+(?= ?[{LETTER}]|\\Z)|\\n(?= ?[{LETTER}]|\\Z)"
    f"|.+?(?:(?<=[{LETTER}0-9!-/:-@\\[-`{{-~])(?= [{LETTER}])|\\Z)", re.DOTALL)
WORD = re.compile(f" ?[{LETTER}]+")


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @staticmethod
    def sizes(count: int, low_bits: int, last: int) -> tuple[int, int, int]:
        """Bytes of the low bits, words of the high bits, number of samples."""
        return -(-count * low_bits // 8), -(-(count + (last >> low_bits) + 1) // 64), -(-count // SAMPLE)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.int64)
        count, last = len(values), int(values[-1])
        low_bits = max(0, (last // count).bit_length() - 1)
        _, words, _ = cls.sizes(count, low_bits, last)
        low = (values[:, None] >> np.arange(low_bits)) & 1
        ones = (values >> low_bits) + np.arange(count)
        unary = np.zeros(words * 64, np.uint8)
        unary[ones] = 1
        high = np.packbits(unary, bitorder="little").view("<u8")
        return cls(count, low_bits, np.packbits(low.astype(np.uint8).ravel(), bitorder="little"), high, ones[::SAMPLE].astype("<u4"))

    def _low(self, i: int) -> int:
        start = i * self.low_bits
        part = int.from_bytes(self.low[start // 8:(start + self.low_bits + 7) // 8].tobytes(), "little")
        return (part >> start % 8) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: from the nearest sample on, words are skipped by their number of ones."""
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        word = place // 64
        bits = int(self.high[word]) >> place % 64 << place % 64
        while left >= bits.bit_count():
            left -= bits.bit_count()
            word += 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        one = word * 64 + (bits & -bits).bit_length() - 1
        return (one - i) << self.low_bits | self._low(i)

    def values(self) -> np.ndarray:
        unary = np.unpackbits(self.high.view(np.uint8), bitorder="little")
        high = np.flatnonzero(unary)[:self.count] - np.arange(self.count)
        bits = np.unpackbits(self.low, count=self.count * self.low_bits, bitorder="little").reshape(self.count, self.low_bits)
        return high << self.low_bits | bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits))


def shard_bytes(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    joined = np.concatenate(ids) if ids else np.empty(0, "<u4")
    width = 2 if not len(joined) or joined.max() < 1 << 16 else 4
    bounds = EliasFano.of(np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]))
    nulls = np.packbits([d is None for d in doc_ids], bitorder="little") if doc_ids else np.empty(0, np.uint8)
    return b"".join([
        HEAD.pack(MAGIC, width, bounds.low_bits, len(doc_ids), len(joined)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), nulls.tobytes(),
        bounds.low.tobytes(), bounds.high.tobytes(), bounds.samples.tobytes(), joined.astype(f"<u{width}").tobytes(),
    ])


class Shard:
    """A shard file's content: doc_ids, boundaries and ids without copies."""

    def __init__(self, content: bytes):
        magic, width, low_bits, n_docs, n_ids = HEAD.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, count, at)
            at += found.nbytes
            return found

        doc_ids, nulls = take("<i8", n_docs), take("u1", -(-n_docs // 8))
        self.null = np.unpackbits(nulls, count=n_docs, bitorder="little").astype(bool)
        self.doc_ids = doc_ids
        low, high, samples = EliasFano.sizes(n_docs + 1, low_bits, n_ids)
        self.bounds = EliasFano(n_docs + 1, low_bits, take("u1", low), take("<u8", high), take("<u4", samples))
        self.ids = take(f"<u{width}", n_ids)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: visible Latin-1 as it is, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """The tokenizers library on whole texts; what it gave for a unit is remembered up to a bound."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.known, self.letters = Tokenizer.from_file(path), {}, byte_letters()

    def learn(self, units: list[str]) -> None:
        """A word is one part of the tokenizer's pattern and goes to its model at once, other units through all steps."""
        others, tokenize = [], self.tokenizer.model.tokenize
        for unit in units:
            if WORD.fullmatch(unit):
                spelt = unit.encode().decode("latin-1").translate(self.letters)
                self.known[unit] = array("I", [t.id for t in tokenize(spelt)]).tobytes()
            else:
                others.append(unit)
        for at in range(0, len(others), 10_000):
            part = others[at:at + 10_000]
            for unit, encoded in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[unit] = array("I", encoded.ids).tobytes()

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > KNOWN_UNITS:
            self.known.clear()
        split = [UNIT.findall(t) for t in texts]
        self.learn(list({u for units in split for u in units if u not in self.known}))
        get, end = self.known.__getitem__, np.array([END], "<u4").tobytes()
        return [np.frombuffer(b"".join([*map(get, units), end]), "<u4") for units in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_shards(tokenizer: str, folder: str, shard_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        store, root = pa.fs.FileSystem.from_uri(folder)
        doc_ids, ids, held = [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:06d}-{uuid.uuid4().hex}.efid"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(shard_bytes(doc_ids, ids))
            return pa.RecordBatch.from_pylist([{"part": part, "number": number, "name": name, "n_docs": len(ids), "n_ids": held}])

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(keys), 256):
                for key, found in zip(keys[at:at + 256], encoder(tokenizer).batch(texts.slice(at, 256).to_pylist())):
                    if held and held + len(found) > shard_ids:
                        yield flush()
                        doc_ids, ids, held, number = [], [], 0, number + 1
                    doc_ids.append(key)
                    ids.append(found)
                    held += len(found)
        if ids:
            yield flush()

    return write


def read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard = Shard(content.as_buffer().to_pybytes())
            bounds = shard.bounds.values()
            crc = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.record_batch([
                pa.array([path.rsplit("/", 1)[-1]] * len(crc), pa.string()), pa.array(shard.doc_ids, pa.int64(), mask=shard.null),
                pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64()),
            ], names=["name", "doc_id", "local", "n_tokens", "ids_crc32"])


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the ids of all texts below ``folder`` (a URI) and return the manifest: part, number, name, n_docs, n_ids."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    store, root = pa.fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    written = rows.select("doc_id", "text").mapInArrow(
        write_shards(tokenizer, folder, shard_ids), "part bigint, number bigint, name string, n_docs bigint, n_ids bigint",
    )
    return materialize(written, "token-manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it in the data set), n_tokens and ids_crc32."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)   # a row per shard, not per document
    shards = manifest.select("name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = manifest.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.efid").load(folder)
    found = files.select("path", "content").mapInArrow(read_shards, "name string, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(shards, "name").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_index(docs: DataFrame, tokenizer: str, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards to a new folder in the shared one and describe each document from them."""
    folder = new_path(docs.sparkSession, "tokens")
    folder = folder if ":" in folder else "file://" + folder
    manifest = write_tokens(docs, tokenizer, folder, shard_ids)
    if manifest.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return read_tokens(manifest, folder)
