import hashlib
import random

import public_tokenizers
import pytest

from clickloom.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a", " a", "a ", "a  b   c", "\n", "a\n\nb \n c", "\t\x0b\r\x00", "▁", "a▁b ▁ ▁▁", "日本語 text 🙂🙃", "é́x", "ab" * 3000,
       " " * 500, "x" * 20_001, "<s></s><unk> <0x41>", "  x"]


def best_score(model, scores, text):
    """Greatest sum over all segmentations, by recursion over suffixes."""
    known = {len(text): 0.0}
    for i in range(len(text) - 1, -1, -1):
        known[i] = max([model.spelt + known[i + 1], *[scores[text[i:j]] + known[j] for j in range(i + 1, len(text) + 1) if text[i:j] in scores]])
    return known[0]


@pytest.mark.parametrize("seed", range(6))
def test_viterbi_equals_all_segmentations(seed):
    rng = random.Random(seed)
    names = {"▁"} | {"".join(rng.choices("ab▁c", k=rng.randrange(1, 5))) for _ in range(14)}
    listed = [(p, -float(rng.randrange(1, 9)), 300 + k) for k, p in enumerate(sorted(names))]
    model = pieces.PieceModel(listed, list(range(256)))
    scores = {p: s for p, s, _ in listed}
    by_id = {i: (p, s) for p, s, i in listed}
    for _ in range(200):
        text = "".join(rng.choices("ab▁cd\n", k=rng.randrange(0, 14)))
        ids = model.viterbi(text)
        got = sum(by_id[i][1] for i in ids if i in by_id) + model.spelt * sum(1 for i in ids if i < 256 and not 0x80 <= i < 0xC0)
        assert got == best_score(model, scores, text)
        assert sum((model.viterbi(part) for part in model.parts(text)), []) == ids


@pytest.mark.parametrize("text", ODD)
def test_exact_round_trip(text):
    model = pieces.model_of(PATH)
    ids = model.encode(text).tolist()
    assert model.decode(ids) == text


def test_only_a_space_piece():
    model = pieces.PieceModel([("▁", -1.0, 300)], list(range(256)))
    assert model.decode(model.encode("é ▁b").tolist()) == "é ▁b"
    with pytest.raises(ValueError, match="space"):
        pieces.PieceModel([("a", -1.0, 300)], list(range(256)))


def test_parts_change_nothing():
    model = pieces.model_of(PATH)
    for text in ("▁The▁quick▁brown.\n\n▁▁Fox▁", "▁a\nb", "▁▁▁x▁▁"):
        assert sum((model.viterbi(p) for p in model.parts(text)), []) == model.viterbi(text)


def test_whole_table_round_trip(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = sorted((r.doc_id, len(r.text), hashlib.sha256(r.text.encode()).hexdigest()) for r in df.collect())
    got = sorted((r.doc_id, r.n_decoded, r.decoded_sha256) for r in pieces.round_trip(df, PATH).collect())
    assert got == want


def test_odd_rows(docs_of):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(98, None), (None, "a b"), (99, "a b"), (99, "a b")]
    got = pieces.round_trip(docs_of(rows, ids="1", n_ids="2"), PATH).collect()
    sha = lambda t: None if t is None else hashlib.sha256(t.encode()).hexdigest()
    assert sorted(((r.doc_id, r.decoded_sha256) for r in got), key=str) == sorted(((d, sha(t)) for d, t in rows), key=str)
    assert {tuple(r.ids) for r in got if r.doc_id in (None, 99)} == {tuple(pieces.model_of(PATH).encode("a b").tolist())}
    assert [r.n_ids for r in got if r.doc_id == 98] == [None]
    assert pieces.round_trip(docs_of([]), PATH).count() == 0
