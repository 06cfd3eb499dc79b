import hashlib

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from clickloom.llm import decontaminate, quality
from clickloom.session import materialize
from tests.llm.test_lines import slow as slow_lines

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage read, and what the last one wrote."""
    docs = [corpus_pipeline.documents(spark, FOLDER)]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs.append(materialize(stage(spark, docs[-1], FOLDER), f"tested-{number}"))
    return docs


def duck(docs, sql):
    con = duckdb.connect()
    frame = docs.toPandas()  # noqa: F841
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{FOLDER}/benchmark.parquet'")
    return con.execute(sql).df()


def test_stages_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding and decoding"]
    assert all(d.columns == stages[0].columns for d in stages[:-1])


def test_quality_rules_keep_what_sql_keeps(stages):
    verdict = duck(stages[0], quality.SQL)
    assert {r.doc_id for r in stages[1].collect()} == set(verdict.doc_id[verdict.kept])
    before = {r.doc_id: r for r in stages[0].collect()}
    assert all(before[r.doc_id] == r for r in stages[1].collect())


def test_line_dedup_equals_brute_force(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    kept = slow_lines(rows)
    assert sorted((r.doc_id, r.text) for r in stages[2].collect()) == sorted((d, kept[(d, t)]) for d, t in rows)
    assert any(kept[r] != r[1] for r in rows) and all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_similar_documents_go(stages):
    """Of texts with five-word similarity of 0.9 one stays, and whatever goes is near one that stays."""
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}

    rows = {r.doc_id: shingles(r.text) for r in stages[2].collect()}
    kept = {r.doc_id for r in stages[3].collect()}
    like = lambda a, b: len(rows[a] & rows[b]) / len(rows[a] | rows[b])
    assert len(kept) < len(rows)
    assert not [(a, b) for a in kept for b in kept if a < b and like(a, b) > 0.9]
    gone = set(rows) - kept
    assert all(max(like(a, b) for b in rows if b != a) > 0.6 for a in gone)


def test_contaminated_documents_go(stages):
    found = duck(stages[3], decontaminate.SQL)
    assert {r.doc_id for r in stages[4].collect()} == set(found.doc_id[~found.contaminated]) and found.contaminated.any()


def test_pieces_decode_to_the_texts(stages):
    want = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in stages[4].collect()}
    assert {r.doc_id: r.decoded_sha256 for r in stages[5].collect()} == want


def test_run_is_the_registered_query(spark, stages):
    got = contract.queries()["pipeline"](spark, FOLDER)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[5].collect()))
    assert "pipeline" not in contract.oracle_sql()


def test_odd_rows_pass_all_stages(spark, docs_of):
    """Nulls in every column, empty texts, repeated rows and columns whose names the stages use: defined results, no crash."""
    words = [f"wort{i}" for i in range(40)]
    text = ". ".join(" ".join(words[k:k + 8]) for k in range(0, 40, 8)) + "."
    other = " ".join(f"other{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, None), (None, text), (3, ""), (4, other, None, None), (5, other + " and more words at its end"), (None, None)]
    docs = docs_of(rows, node="1", root="2", _row="3", chunks="4", kept="5", item_id="6")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = materialize(stage(spark, docs, FOLDER), "odd")
        assert docs.columns == columns, name
    left = docs.collect()
    assert sorted(r.doc_id for r in left if r.doc_id) == [1, 4] and {r.text for r in left if r.text} == {text, other}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == len(left)


def test_an_empty_table_passes_all_stages(spark, docs_of):
    docs = docs_of([], node="1")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER), "empty")
        assert docs.count() == 0
