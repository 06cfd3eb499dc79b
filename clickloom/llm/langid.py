"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary of pieces.

A word's probability in a language is the sum over all ways to cut it into pieces of the product of their probabilities,
found by a forward pass; a text's is the product over its words, since no piece reaches over white space. The
probabilities are estimated by expectation-maximisation from word counts of the labelled training rows: Spark counts
(language, word) pairs over the whole table, each round runs forward-backward on the counted words where they lie and
sums the expected uses of pieces, of which there are at most vocabulary x languages.

Defined results: a null text or one without a letter is `und` with score 0, and so is everything if no row has a label;
equal probabilities go to the language that sorts first; a null doc_id counts as empty text for the split.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.base import text_of
from clickloom.session import materialize

SPACE = "▁"
ROUNDS = 2
PRIOR_WEIGHT = 1000.0    # uses of pieces that every language is credited with beforehand
LEAST = 1e-200    # smaller chances are summed as logarithms
KNOWN_WORDS = 200_000    # words a worker remembers before it starts anew
ROWS = 2048              # words of one length that are scored at once
NEVER = -1e30
LETTER = regex.compile(r"\p{L}")
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The vocabulary; number ``len(self)`` - 1 stands for any character that is no piece."""

    def __init__(self, names: list[str]):
        self.names = names
        self.longest = max(map(len, names), default=1)
        hashes = np.array([self._hash(p) for p in names], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def __len__(self) -> int:
        return len(self.names) + 1

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(FACTOR) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def matches(self, words: list[str]) -> list[np.ndarray]:
        """For words of one length: per piece length k, the piece at each start (rows: words), -1 for none."""
        n = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), n).astype(np.uint64) + np.uint64(1)
        found, h = [], np.zeros_like(codes)
        for k in range(1, min(n, self.longest) + 1):
            h = h[:, :n - k + 1] * FACTOR + codes[:, k - 1:]
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            found.append(np.where(self.hashes[at] == h, self.order[at], len(self.names) if k == 1 else -1))
        return found


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    """Ordinary pieces of a SentencePiece model, most frequent first as the model lists them."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return Pieces([model.id_to_piece(i) for i in range(model.get_piece_size()) if not special(i)])


def log_sum(parts: list[np.ndarray]) -> np.ndarray:
    if len(parts) == 1:
        return parts[0]
    stacked = np.stack(parts)
    top = stacked.max(axis=0)
    return top + np.log(np.exp(stacked - top).sum(axis=0))


def forward(found: list[np.ndarray], use: list[np.ndarray], n: int) -> list[np.ndarray]:
    """Log probability of every prefix; ``use[k][:, i]`` is that of the piece of length k + 1 at i."""
    alpha = [np.zeros(use[0].shape[:1] + use[0].shape[2:], np.float64)]
    for j in range(1, n + 1):
        alpha.append(log_sum([alpha[j - k] + use[k - 1][:, j - k] for k in range(1, min(j, len(found)) + 1)]))
    return alpha


def prefix_sums(found: list[np.ndarray], use: list[np.ndarray], n: int) -> list[np.ndarray]:
    """The same with probabilities instead of their logarithms, for words that do not underflow."""
    alpha = [np.ones(use[0].shape[:1] + use[0].shape[2:], np.float64)]
    for j in range(1, n + 1):
        total = alpha[j - 1] * use[0][:, j - 1]
        for k in range(2, min(j, len(found)) + 1):
            total += alpha[j - k] * use[k - 1][:, j - k]
        alpha.append(total)
    return alpha


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Places of words of equal length, a bounded number of characters at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        places = np.flatnonzero(lengths == n)
        rows = max(1, min(ROWS, 100_000 // int(n)))
        for at in range(0, len(places), rows):
            yield int(n), places[at:at + rows]


def word_scores(pieces: Pieces, log_p: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of each word (rows) in each language (columns). The last row of ``log_p`` is for no piece."""
    scores, p = np.empty((len(words), log_p.shape[1])), np.exp(log_p)
    marked = [SPACE + w for w in words]
    for n, places in by_length(marked):
        found = pieces.matches([marked[i] for i in places])
        total = prefix_sums(found, [p[f] for f in found], n)[-1]
        small = (total < LEAST).any(axis=1)
        scores[places] = np.log(np.maximum(total, LEAST))
        if small.any():
            rest = [f[small] for f in found]
            scores[places[small]] = forward(rest, [log_p[f] for f in rest], n)[-1]
    return scores


def expected_uses(pieces: Pieces, log_p: np.ndarray, words: list[str], language: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (rows) in each language by forward-backward, each word in its own language."""
    n_languages = log_p.shape[1]
    uses, p = np.zeros(log_p.shape[0] * n_languages), np.exp(log_p)
    marked = [SPACE + w for w in words]

    def add(found: list[np.ndarray], own: np.ndarray, chances: Iterator[np.ndarray], weights: np.ndarray) -> None:
        nonlocal uses
        for f, chance in zip(found, chances):
            some = f >= 0
            uses += np.bincount((f * n_languages + own)[some], weights=(chance * weights[:, None])[some], minlength=len(uses))

    def from_logarithms(found: list[np.ndarray], own: np.ndarray, n: int) -> Iterator[np.ndarray]:
        use = [log_p[f, own] for f in found]
        alpha = forward(found, use, n)
        beta = [None] * n + [np.zeros(len(own))]
        for i in range(n - 1, -1, -1):
            beta[i] = log_sum([use[k - 1][:, i] + beta[i + k] for k in range(1, min(n - i, len(found)) + 1)])
        for k in range(1, len(found) + 1):
            yield np.exp(np.stack(alpha[:n - k + 1], axis=1) + use[k - 1] + np.stack(beta[k:], axis=1) - alpha[n][:, None])

    for n, places in by_length(marked):
        found = pieces.matches([marked[i] for i in places])
        own = language[places][:, None]
        use = [p[f, own] for f in found]
        alpha = prefix_sums(found, use, n)
        beta = [None] * n + [np.ones(len(places))]
        for i in range(n - 1, -1, -1):
            beta[i] = use[0][:, i] * beta[i + 1]
            for k in range(2, min(n - i, len(found)) + 1):
                beta[i] += use[k - 1][:, i] * beta[i + k]
        small = alpha[n] < LEAST
        whole = np.where(small, 1.0, alpha[n])[:, None]
        weights = np.where(small, 0.0, weight[places])
        add(found, own, (np.stack(alpha[:n - k + 1], axis=1) * use[k - 1] * np.stack(beta[k:], axis=1) / whole for k in range(1, len(found) + 1)), weights)
        if small.any():
            rest = [f[small] for f in found]
            add(rest, own[small], from_logarithms(rest, own[small], n), weight[places[small]])
    return uses.reshape(log_p.shape)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = defaultdict(Counter)
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[lang].update(text.split())
        for lang, words in counts.items():
            yield pa.record_batch([pa.array([lang] * len(words)), pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())],
                                  names=["lang", "word", "n"])


def sum_uses(path: str, log_p: np.ndarray, languages: list[str]):
    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, total = vocabulary(path), np.zeros(log_p.shape)
        number = {lang: k for k, lang in enumerate(languages)}
        for batch in batches:
            language = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            total += expected_uses(pieces, log_p, batch.column(1).to_pylist(), language, batch.column(2).to_numpy().astype(np.float64))
        piece, lang = np.nonzero(total)
        yield pa.record_batch([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], names=["piece", "lang", "uses"])

    return uses


def train(rows: DataFrame, path: str, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """From rows (text, lang): the languages, log probabilities of pieces (a row more, for none), log shares of languages."""
    labelled = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(share)
    pieces = vocabulary(path)
    # Byte-pair vocabularies list pieces by frequency, so a Zipf law is the start that they tell.
    start = 1 / np.arange(1, len(pieces) + 1)
    start /= start.sum()
    log_p = np.full((len(pieces) + 1, max(1, len(languages))), NEVER)
    log_p[:-1] = np.log(start)[:, None]
    if not languages:
        return [], log_p, np.zeros(1)
    counted = labelled.select("text", "lang").mapInArrow(count_words, "lang string, word string, n bigint")
    words = materialize(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words-by-language")
    for _ in range(rounds):
        found = words.mapInArrow(sum_uses(path, log_p, languages), "piece bigint, lang bigint, uses double")
        total = found.groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toArrow()   # at most vocabulary x languages rows
        uses = np.zeros((len(pieces), len(languages)))
        uses[total["piece"].to_numpy(), total["lang"].to_numpy()] = total["uses"].to_numpy()
        log_p[:-1] = np.log((uses + PRIOR_WEIGHT * start[:, None]) / (uses.sum(axis=0) + PRIOR_WEIGHT))
    shares = np.array([share[lang] for lang in languages], float)
    return languages, log_p, np.log(shares / shares.sum())


class Scorer:
    """Scores texts and remembers words up to a bound."""

    def __init__(self, path: str, languages: list[str], log_p: np.ndarray, shares: np.ndarray):
        self.pieces, self.languages, self.log_p, self.shares = vocabulary(path), languages, log_p, shares
        self.forget()

    def forget(self) -> None:
        self.known = defaultdict()
        self.known.default_factory = self.known.__len__
        self.scores = np.empty((0, len(self.shares)))

    def batch(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        number = self.known.__getitem__
        split = [np.fromiter(map(number, t.split()), np.int64) if t and self.languages and LETTER.search(t) else None for t in texts]
        new = list(self.known)[len(self.scores):]
        self.scores = np.concatenate([self.scores, word_scores(self.pieces, self.log_p, new)]) if new else self.scores
        found = []
        for words in split:
            if words is None:
                found.append(("und", 0.0))
                continue
            total = self.shares + self.scores[words].sum(axis=0)
            best = int(total.argmax())
            found.append((self.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return found


def predict(path: str, languages: list[str], log_p: np.ndarray, shares: np.ndarray):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(path, languages, log_p, shares)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                found = scorer.batch(part.column(2).to_pylist())
                yield pa.record_batch([part.column(0), part.column(1), pa.array([x for x, _ in found], pa.string()),
                                       pa.array([x for _, x in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return label


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts == part


def identify(docs: DataFrame, path: str, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, held_out, the predicted language and its posterior. Learns from labelled rows that are not held out."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id"), 3, 1).alias("held_out"), "text", "lang")
    model = train(rows.where(~F.col("held_out")).select(text_of().alias("text"), "lang"), path, rounds)
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        predict(path, *model), "doc_id bigint, held_out boolean, lang_pred string, score double",
    )
