"""SentencePiece encoding by a Viterbi search that an Aho-Corasick automaton drives, and exact decoding.

The automaton holds all ordinary pieces. Reading a text once, it reports at each character the pieces that end there,
longest first along its output links, and each relaxes the best score of the text so far; a character that no piece ends
at is spelt in byte pieces. The result is the segmentation with the greatest sum of piece scores; between equal sums the
one whose last piece is longest is taken. Texts are cut where no piece can reach across (before a run of spaces that
follows something else, around line ends), which changes nothing, and what was found for a part is remembered.

Spaces become the mark U+2581 and one is put in front; a mark in the text itself is spelt in bytes, so decoding gives
back every text exactly. Defined results: a null text has null ids and decodes to null, an empty text has one id or more
for the space in front; ids that are no pieces fail to decode; repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
KNOWN_PARTS = 1 << 19    # parts a worker remembers before it starts anew
PART = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


class PieceModel:
    """Pieces and scores, the automaton over them, and the ids of byte pieces."""

    def __init__(self, pieces: list[tuple[str, float, int]], byte_ids: list[int]):
        import ahocorasick
        if sorted(byte_ids) != sorted(set(byte_ids)) or len(byte_ids) != 256:
            raise ValueError("a model with 256 byte pieces is needed")
        if all(piece != SPACE for piece, _, _ in pieces):
            raise ValueError("a model with a piece for the space is needed, or it could not be told from a mark in bytes")
        self.automaton = ahocorasick.Automaton()
        for piece, score, number in pieces:
            self.automaton.add_word(piece, (len(piece), score, number))
        self.automaton.make_automaton()
        self.byte_ids = byte_ids
        self.spelt = min(s for _, s, _ in pieces) - 10     # the score of a character in bytes
        self.bytes_of = {number: piece.replace(SPACE, " ").encode() for piece, _, number in pieces}
        self.bytes_of |= {number: bytes([b]) for b, number in enumerate(byte_ids)}
        crossing = any(SPACE in piece.lstrip(SPACE) or ("\n" in piece and len(piece) > 1) for piece, _, _ in pieces)
        self.parts = (lambda text: [text]) if crossing else PART.findall
        self.known = {}

    def spell(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()]

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best segmentation of a text in which marks stand for spaces."""
        n = len(text)
        best, back = [0.0] * (n + 1), [(0, -1)] * (n + 1)
        done = 0
        for last, (length, score, number) in self.automaton.iter(text):
            while done <= last:
                done += 1
                best[done], back[done] = best[done - 1] + self.spelt, (1, -1)
            total = best[last + 1 - length] + score
            if total > best[last + 1]:
                best[last + 1], back[last + 1] = total, (length, number)
        while done < n:
            done += 1
            best[done], back[done] = best[done - 1] + self.spelt, (1, -1)
        ids = []
        while n:
            length, number = back[n]
            ids += [number] if number >= 0 else self.spell(text[n - 1])[::-1]
            n -= length
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        if len(self.known) > KNOWN_PARTS:
            self.known.clear()
        known, found = self.known, []
        for k, stretch in enumerate(text.split(SPACE)):
            if k:
                found.append(np.array(self.spell(SPACE), "<i4").tobytes())
            parts = self.parts((SPACE if not k else "") + stretch.replace(" ", SPACE))
            for part in parts:
                ids = known.get(part)
                if ids is None:
                    ids = known[part] = np.array(self.viterbi(part), "<i4").tobytes()
                found.append(ids)
        return np.frombuffer(b"".join(found), "<i4")

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode()[1:]


@lru_cache(maxsize=2)
def model_of(path: str) -> PieceModel:
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(m.get_piece_size())
    ordinary = [i for i in numbers if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    in_bytes = {int(m.id_to_piece(i)[3:5], 16): i for i in numbers if m.is_byte(i)}
    return PieceModel([(m.id_to_piece(i), m.get_score(i), i) for i in ordinary], [in_bytes[b] for b in range(256)])


def encode_rows(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = [None if t is None else model.encode(t) for t in part.column(1).to_pylist()]
                offsets = np.cumsum([0, *[0 if x is None else len(x) for x in found]]).astype(np.int32)
                ids = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.concatenate([np.empty(0, "<i4"), *[x for x in found if x is not None]])),
                    mask=pa.array([x is None for x in found]))
                yield pa.record_batch([part.column(0), ids], names=["doc_id", "ids"])

    return encode


def decode_rows(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = [None if ids is None else model.decode(ids) for ids in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return decode


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id and the ids of its text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(encode_rows(path), "doc_id bigint, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """Per row (doc_id, ids): the same with the text."""
    return rows.select("doc_id", "ids").mapInArrow(decode_rows(path), "doc_id bigint, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, ids, their number, the decoded text's sha256 and length; all null for a null text."""
    return decoded(encoded(docs, path), path).select(
        "doc_id", "ids", F.when(F.col("ids").isNotNull(), F.size("ids")).cast("bigint").alias("n_ids"),
        F.char_length("text").cast("bigint").alias("n_decoded"), F.sha2("text", 256).alias("decoded_sha256"))
