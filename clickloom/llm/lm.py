"""A hashed maximum-entropy language model with a class-factored softmax, and add-one unigram scores.

The documents are tokenised once into chunks of bounded size: one row holds the token ids of many documents and the
chunk's own word list. Word counts of the whole training part come from summing these lists, and travel back to the
chunks by a join on the word, so neither the vocabulary nor a text ever passes through one place.

Every word belongs to a leaf: words with at least a 1/256 share of the training tokens have one of their own, the others
share one by their last two letters; 32 leaves make a class. P(word | context) = P(class | context) P(leaf | class,
context) P(word | leaf). The first two are softmaxes over summed weights of hashed features (previous word, previous two
words, word before last, word before that), the third is an add-one unigram within the leaf, with one event for all
unknown words. Tasks train by mini-batch gradient steps on their chunks and their weights, a table of fixed size, are
averaged by tokens; more rounds start from the average. Scoring is batched numpy on the same chunks.

Defined results: a null text is an empty one, of one token (the end); without training tokens all counts are zero;
repeated rows count as often as they occur and score equally; a null doc_id counts as empty text for the split.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.base import raw_texts
from clickloom.llm.langid import held_out
from clickloom.session import materialize

CHUNK_BYTES = 1 << 24
SEED = 42
CLASSES, MEMBERS = 16, 32
HEADS = CLASSES * MEMBERS // 2           # leaves of one frequent word; the other half are shared
CLASS_ROWS, MEMBER_ROWS = 1 << 14, 1 << 15
CONTEXTS = 4
BATCH, RATE, ROUNDS = 4096, 0.15, 1
LOGIT = 40                               # weights add up to no more than this
BLOCK = 1 << 14                          # weights in one row of the averaging
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def packed(ids: np.ndarray) -> bytes:
    """Token ids byte plane by byte plane: words get numbers as they appear, so the upper planes are nearly empty."""
    return zstandard.ZstdCompressor(level=1).compress(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(content: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(content), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def tokenise(chunk_bytes: int):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (doc_id, held_out, text) to one row per chunk; the end of a document is the empty word, number 0."""
        part, number = TaskContext.get().partitionId(), 0

        def fresh() -> tuple:
            known = defaultdict()
            known.default_factory = known.__len__
            known[b""]
            return known, [], [], [], [], 0

        def row() -> pa.RecordBatch:
            lens = np.array([len(x) for x in tokens], np.int32)
            train = [x for x, h in zip(tokens, held) if not h]
            counts = np.bincount(np.concatenate(train), minlength=len(known)) if train else np.zeros(len(known), np.int64)
            return pa.record_batch([
                pa.array([part << 32 | number]), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
                pa.array([lens.tobytes()]), pa.array([packed(np.concatenate(tokens))]),
                pa.array([list(known)], pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())),
            ], names=["chunk", "doc_ids", "held", "lens", "ids", "words", "counts"])

        known, ids, held, tokens, _, size = fresh()
        for batch in batches:
            for doc_id, out, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw_texts(batch.column(2))):
                if size and size + len(raw) > chunk_bytes:
                    yield row()
                    known, ids, held, tokens, _, size = fresh()
                    number += 1
                words = raw.lower().split()
                found = np.zeros(len(words) + 1, np.int32)
                found[:-1] = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                ids.append(doc_id)
                held.append(out)
                tokens.append(found)
                size += len(raw) + 1
        if ids:
            yield row()

    return chunks


CHUNK = "chunk bigint, doc_ids array<bigint>, held array<boolean>, lens binary, ids binary, words array<string>, counts array<bigint>"


class Lexicon:
    """Leaves and feature hashes of words, from the list of frequent words alone."""

    def __init__(self, heads: list[str]):
        self.rank = {word: k for k, word in enumerate(heads)}

    def leaf(self, word: str) -> int:
        own = self.rank.get(word)
        if own is not None:
            return own
        ending = xxhash.xxh64_intdigest(word[-2:].encode(), SEED)
        return HEADS + (ending - (1 << 64) if ending >> 63 else ending) % (CLASSES * MEMBERS - HEADS)

    def arrays(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        leaves = np.fromiter(map(self.leaf, words), np.int64, len(words))
        hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode(), SEED) for w in words), np.uint64, len(words))
        return leaves, hashes


class Weights:
    """All parameters in one vector of fixed length, with views as tables."""

    SIZES = [(CLASSES,), (CLASSES, MEMBERS), (CLASS_ROWS, CLASSES), (MEMBER_ROWS, MEMBERS)]
    LENGTH = sum(int(np.prod(s)) for s in SIZES)

    def __init__(self, flat: np.ndarray):
        self.flat, at, views = flat, 0, []
        for shape in self.SIZES:
            views.append(flat[at:at + int(np.prod(shape))].reshape(shape))
            at += views[-1].size
        self.class_bias, self.member_bias, self.by_class, self.by_member = views

    @classmethod
    def start(cls, leaf_tokens: np.ndarray) -> Weights:
        """The unigram model of leaves."""
        made = cls(np.zeros(cls.LENGTH, np.float32))
        share = (leaf_tokens + 0.5).reshape(CLASSES, MEMBERS)
        made.class_bias[:] = np.log(share.sum(axis=1) / share.sum())
        made.member_bias[:] = np.log(share / share.sum(axis=1, keepdims=True))
        return made


def place_in_text(lens: np.ndarray) -> np.ndarray:
    """How many tokens of its text come before each token."""
    starts = np.cumsum(lens) - lens
    return (np.arange(lens.sum()) - np.repeat(starts, lens)).astype(np.int32)


def contexts(ids: np.ndarray, into: np.ndarray, hashes: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Feature hashes per token (rows) from begin to end: previous word, previous two, word before last, the one before that."""
    reach = min(begin, CONTEXTS - 1)
    own = hashes[ids[begin - reach:end]]

    def back(k: int) -> np.ndarray:
        moved = np.zeros(end - begin, np.uint64)
        there = own[max(0, reach - k):len(own) - k]
        moved[len(moved) - len(there):] = there
        moved[into[begin:end] < k] = 0
        return moved

    one, two, three = back(1), back(2), back(3)
    mixed = np.stack([one, one * MIX[1] + two, two, three], axis=1)
    mixed = (mixed + MIX) * MIX
    return mixed ^ (mixed >> np.uint64(29))


def rows_of(feature: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by_class = (feature * MIX[0] >> np.uint64(64 - CLASS_ROWS.bit_length() + 1)).astype(np.int64)
    with_class = (feature ^ (classes.astype(np.uint64) + np.uint64(1))[:, None] * MIX[2]) * MIX[3]
    return by_class, (with_class >> np.uint64(64 - MEMBER_ROWS.bit_length() + 1)).astype(np.int64)


def softmax(scores: np.ndarray) -> np.ndarray:
    np.clip(scores, -LOGIT, LOGIT, out=scores)
    np.exp(scores, out=scores)
    scores /= (scores @ np.ones(scores.shape[1], scores.dtype))[:, None]
    return scores


def chances(weights: Weights, feature: np.ndarray, leaf: np.ndarray) -> tuple:
    """The two softmaxes of a batch, with what their gradients need."""
    classes, member = np.divmod(leaf, MEMBERS)
    by_class, by_member = rows_of(feature, classes)
    p_class, p_member = weights.by_class.take(by_class[:, 0], axis=0), weights.by_member.take(by_member[:, 0], axis=0)
    p_class += weights.class_bias
    p_member += weights.member_bias.take(classes, axis=0)
    for k in range(1, CONTEXTS):
        p_class += weights.by_class.take(by_class[:, k], axis=0)
        p_member += weights.by_member.take(by_member[:, k], axis=0)
    return softmax(p_class), softmax(p_member), classes, member, by_class, by_member


def step(table: np.ndarray, rows: np.ndarray, slope: np.ndarray, rate: float) -> None:
    """Move the table's rows against their summed slopes, each by its sum over the root of its number of uses."""
    flat, column = table.reshape(-1), np.arange(slope.shape[1])
    used = np.bincount(rows.ravel(), minlength=len(table))
    scale = (-rate / np.sqrt(used[rows])).astype(np.float32)
    for k in range(rows.shape[1]):
        np.add.at(flat, (rows[:, k, None] * slope.shape[1] + column).ravel(), (slope * scale[:, k, None]).ravel())


def train_batch(weights: Weights, feature: np.ndarray, leaf: np.ndarray, rate: float) -> None:
    p_class, p_member, classes, member, by_class, by_member = chances(weights, feature, leaf)
    at = np.arange(len(leaf))
    p_class[at, classes] -= 1
    p_member[at, member] -= 1
    step(weights.by_class, by_class, p_class, rate)
    step(weights.by_member, by_member, p_member, rate)


def gradient_updates(heads: list[str], start: np.ndarray, rate: float):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's chunks to the weights it ends with, in blocks, with the number of tokens it saw."""
        lexicon, weights, seen = Lexicon(heads), Weights(start.copy()), 0
        for batch in batches:
            for held, lens, ids, words in zip(*(batch.column(k) for k in range(4))):
                lens, ids = np.frombuffer(lens.as_py(), "<i4"), unpacked(ids.as_py())
                keep = ~np.array(held.as_py(), bool)
                ids, lens = ids[np.repeat(keep, lens)], lens[keep]
                if not len(ids):
                    continue
                leaves, hashes = lexicon.arrays(words.as_py())
                into = place_in_text(lens)
                for at in range(0, len(ids), BATCH):
                    end = min(len(ids), at + BATCH)
                    train_batch(weights, contexts(ids, into, hashes, at, end), leaves[ids[at:end]], rate)
                seen += len(ids)
        if seen:
            blocks = range(0, Weights.LENGTH, BLOCK)
            yield pa.record_batch([
                pa.array([k // BLOCK for k in blocks]), pa.array([seen] * len(blocks)),
                pa.array([weights.flat[k:k + BLOCK].tobytes() for k in blocks], pa.binary()),
            ], names=["block", "tokens", "w"])

    return train


def mean_block(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, tokens = 0.0, 0
    for batch in batches:
        for n, w in zip(batch.column("tokens").to_pylist(), batch.column("w")):
            total, tokens = total + np.frombuffer(w.as_py(), np.float32).astype(np.float64) * n, tokens + n
    yield pa.record_batch([pa.array([key[0].as_py()]), pa.array([tokens]), pa.array([(total / tokens).astype(np.float32).tobytes()])],
                          names=["block", "tokens", "w"])


def averaged(updates: DataFrame) -> np.ndarray | None:
    """The token-weighted mean of the tasks' weights, first within sixteen parts of the tasks, then over these."""
    kind = "block bigint, tokens bigint, w binary"
    split = updates.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(16)))
    half = split.groupBy("block", "part").applyInArrow(mean_block, kind)
    rows = half.groupBy("block").applyInArrow(mean_block, kind).orderBy("block").collect()   # the model, of fixed size
    return np.concatenate([np.frombuffer(r["w"], np.float32) for r in rows]).copy() if rows else None


def score_chunks(heads: list[str], flat: np.ndarray, leaf_tokens: np.ndarray, leaf_words: np.ndarray, n_tokens: int, n_words: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights = Lexicon(heads), Weights(flat)
        below = np.log10(leaf_tokens + leaf_words + 1.0)
        for batch in batches:
            for doc_ids, held, lens, ids, words, pos, c in zip(*(batch.column(k) for k in range(7))):
                lens, ids = np.frombuffer(lens.as_py(), "<i4"), unpacked(ids.as_py())
                leaves, hashes = lexicon.arrays(words.as_py())
                counts = np.zeros(len(leaves))
                if pos.values is not None:
                    counts[pos.values.to_numpy()] = c.values.to_numpy()
                base = np.log10((counts + 1) / (n_tokens + n_words + 1))
                within = np.where(leaves < HEADS, 0, np.log10(counts + 1) - below[leaves])
                into, log_p = place_in_text(lens), within[ids]
                for at in range(0, len(ids), BATCH):
                    end = min(len(ids), at + BATCH)
                    p_class, p_member, classes, member, _, _ = chances(weights, contexts(ids, into, hashes, at, end), leaves[ids[at:end]])
                    row = np.arange(len(classes))
                    log_p[at:end] += np.log10(p_class[row, classes].astype(np.float64)) + np.log10(p_member[row, member].astype(np.float64))
                starts = np.cumsum(lens) - lens
                total = lambda x: pa.array(np.add.reduceat(x, starts))
                yield pa.record_batch([
                    pa.array(doc_ids.as_py(), pa.int64()), pa.array(held.as_py(), pa.bool_()), pa.array(lens.astype(np.int64)),
                    total((counts[ids] > 0).astype(np.int64)), pa.array(np.full(len(lens), n_tokens)), total(base[ids]), total(log_p),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def language_model(docs: DataFrame, rounds: int = ROUNDS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities of the text)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id"), 7, 2).alias("held_out"), F.col("text"))
    chunks = materialize(rows.mapInArrow(tokenise(chunk_bytes), CHUNK), "token-chunks")
    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "x"))
    listed = listed.select("chunk", "pos", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    counts = materialize(listed.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "word-counts")

    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_tokens, n_words = int(sums["n"]), int(sums["v"])
    # At most HEADS words can have a share of 1 / HEADS; the end of a text always has a leaf of its own.
    frequent = counts.where((F.col("c") * HEADS >= n_tokens) & (F.col("word") != "")).orderBy(F.desc("c"), "word").collect()
    heads = ["", *[r["word"] for r in frequent]][:HEADS]
    own = F.array_position(F.lit(heads), F.col("word")) - 1
    shared = F.pmod(F.xxhash64(F.substring("word", -2, 2)), F.lit(CLASSES * MEMBERS - HEADS)) + HEADS
    leaf = F.when(own >= 0, own).otherwise(shared)
    leaf_tokens, leaf_words = np.zeros(CLASSES * MEMBERS), np.zeros(CLASSES * MEMBERS)
    for r in counts.groupBy(leaf.alias("leaf")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        leaf_tokens[r["leaf"]], leaf_words[r["leaf"]] = r["n"], r["v"]

    flat = Weights.start(leaf_tokens).flat
    for _ in range(rounds):
        updates = chunks.select("held", "lens", "ids", "words").mapInArrow(gradient_updates(heads, flat, RATE), "block bigint, tokens bigint, w binary")
        found = averaged(updates)
        flat = flat if found is None else found

    known = listed.select("chunk", "pos", "word").join(counts, "word")
    # A chunk's word list is bounded; both lists see the rows of a chunk in the same order.
    known = known.groupBy("chunk").agg(F.collect_list("pos").alias("pos"), F.collect_list("c").alias("c"))
    ready = chunks.drop("counts").join(known, "chunk", "left").select("doc_ids", "held", "lens", "ids", "words", "pos", "c")
    return ready.mapInArrow(
        score_chunks(heads, flat, leaf_tokens, leaf_words, n_tokens, n_words),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
