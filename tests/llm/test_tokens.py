import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.001"
ODD = ["", " ", "  two  spaces ", "a\n\n b", "it's we'll they've 1 000,00 $5", "tab\t x\x0b y\x0c\x00 z", "naïve Ñandú Ärger œuvre", "日本 語 🙂 🙃 x",
       "<|endoftext|> a <|endoftext|>b", "x" * 20_000, " " * 3000 + "z", "a b​ c d ᠎ e", "\r\n Hello \r\n World", "é ́x . A -- B"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(df, library, **kw):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, h, r.doc_id, r.text or "") for r, h in df.select(F.struct("*"), F.xxhash64(F.coalesce("text", F.lit("")))).collect()))
    want, start = [], 0
    for *_, doc_id, text in rows:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in tokens.token_index(df, PATH, **kw).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_whole_table_equals_the_library(spark, library):
    check(spark.read.parquet(f"{FOLDER}/documents.parquet"), library)


def test_odd_rows_and_small_shards(docs_of, library):
    rows = [(i * 3 % 17, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, None), (5, "again"), (5, "again")]
    check(docs_of(rows, h="1", start="2", n_tokens="3"), library, shard_ids=50)


def test_units_join_to_the_text(library):
    encoder = tokens.Encoder(PATH)
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\n\n", "\t", ".", ",", "'", "'s", "’", '"', "a", "Zeta", "éa", "λ", "Ж", "́", "1", "23", "|", "!?", "-", "\u00a0", "ﬁ", "🙂", "<|endoftext|>"]
    for text in [*ODD, *("".join(rng.choices(parts, k=rng.randrange(1, 25))) for _ in range(4000))]:
        assert "".join(tokens.UNIT.findall(text)) == text
        assert encoder.batch([text])[0].tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [0, 5], [7, 7, 2**40], list(range(2000)), [0, *[10**6] * 700, 10**6 + 1]])
def test_elias_fano(values):
    made = tokens.EliasFano.of(np.array(values))
    assert made.values().tolist() == values
    assert [made.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    bounds = np.cumsum(np.random.default_rng(1).integers(1, 1200, 100_000))
    made = tokens.EliasFano.of(bounds)
    assert (made.low.nbytes + made.high.nbytes + made.samples.nbytes) * 8 < 13 * len(bounds)


def test_documents_of_a_shard():
    ids = [np.array(x, "<u4") for x in ([1, 2], [70_000], [3, 4, 5])]
    shard = tokens.Shard(tokens.shard_bytes([4, None, 9], ids))
    assert [shard.document(i).tolist() for i in range(3)] == [[1, 2], [70_000], [3, 4, 5]]
    assert shard.null.tolist() == [False, True, False]


def test_empty_table(docs_of):
    assert tokens.token_index(docs_of([]), PATH).count() == 0
