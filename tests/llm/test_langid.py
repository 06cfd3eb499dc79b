import math
import random
import zlib

import numpy as np
import public_tokenizers
from clickloom.llm import langid

PATH = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.01"


def all_segmentations(text, p, unknown):
    """Sum over all segmentations by listing them; a single character that is no piece has the chance ``unknown``."""
    if not text:
        return [1.0]
    total = []
    for k in range(1, len(text) + 1):
        chance = p.get(text[:k], unknown if k == 1 else None)
        if chance:
            total += [chance * rest for rest in all_segmentations(text[k:], p, unknown)]
    return total


def toy(seed):
    rng = random.Random(seed)
    names = sorted({"▁", *("".join(rng.choices("▁abc", k=rng.randrange(1, 4))) for _ in range(12))})
    pieces = langid.Pieces(names)
    log_p = np.full((len(pieces) + 1, 2), langid.NEVER)
    log_p[:-1] = np.log(np.random.default_rng(seed).dirichlet(np.ones(len(pieces)), 2).T)
    words = ["".join(rng.choices("abcd", k=rng.randrange(1, 8))) for _ in range(60)]
    return names, pieces, log_p, words


def test_forward_sums_all_segmentations():
    for seed in range(4):
        names, pieces, log_p, words = toy(seed)
        scores = langid.word_scores(pieces, log_p, words)
        for lang in range(2):
            p = {name: math.exp(log_p[i, lang]) for i, name in enumerate(names)}
            for word, got in zip(words, scores[:, lang]):
                assert math.isclose(got, math.log(sum(all_segmentations("▁" + word, p, math.exp(log_p[len(names), lang])))), rel_tol=1e-9)


def test_expected_uses_are_the_slope_of_the_likelihood():
    """The derivative of a word's log probability by the log probability of a piece is its expected use."""
    names, pieces, log_p, words = toy(9)
    language = np.arange(len(words)) % 2
    weight = np.linspace(1, 2, len(words))
    uses = langid.expected_uses(pieces, log_p, words, language, weight)
    value = lambda table: (langid.word_scores(pieces, table, words)[np.arange(len(words)), language] * weight).sum()
    for piece in range(len(pieces)):
        for lang in range(2):
            up, down = log_p.copy(), log_p.copy()
            up[piece, lang] += 1e-5
            down[piece, lang] -= 1e-5
            assert math.isclose(uses[piece, lang], (value(up) - value(down)) / 2e-5, rel_tol=1e-4, abs_tol=1e-6)


def test_long_words_do_not_vanish():
    pieces = langid.Pieces(["▁", "a", "aa"])
    log_p = np.full((5, 1), langid.NEVER)
    log_p[:-1, 0] = np.log([0.4, 0.3, 0.2, 0.1])
    score = langid.word_scores(pieces, log_p, ["a" * 5000, "b" * 2000])
    assert np.isfinite(score).all() and score[1, 0] == np.log(0.4) + 2000 * np.log(0.1) or abs(score[1, 0] - (np.log(0.4) + 2000 * np.log(0.1))) < 1e-6


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = langid.identify(df, PATH).toPandas().merge(df.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(got) == df.count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all()
    assert (got.lang == got.lang_pred)[got.held_out].mean() > 0.97


def test_odd_rows(docs_of):
    rows = [(i, "the house and the garden", "en", None) for i in range(20)] + [(100 + i, "das Haus und der Garten", "de", None) for i in range(20)]
    rows += [(200, None, "en", None), (201, "", None, None), (202, "12 34 !!", "de", None), (203, "und der the", None, None), (None, "das Haus", None, None),
             (204, "x" * 3000 + " " + "the and " * 3000, "en", None), (205, "日本", None, None), (206, "the garden", None, None), (206, "the garden", None, None)]
    got = {}
    for r in langid.identify(docs_of(rows, score="1", lang_pred="2"), PATH).collect():
        got.setdefault(r.doc_id, (r.lang_pred, r.score))
    assert got[200] == got[201] == got[202] == ("und", 0.0)
    assert got[206][0] == "en" and got[204][0] == "en" and got[None][0] == "de" and 0 < got[205][1] <= 1


def test_no_labels_and_no_rows(docs_of):
    assert {(r.lang_pred, r.score) for r in langid.identify(docs_of([(1, "some words"), (2, "more")]), PATH).collect()} == {("und", 0.0)}
    assert langid.identify(docs_of([]), PATH).count() == 0
