import hashlib
import random
import re

import pytest
import xxhash

from clickloom.llm import lines

FOLDER = "/root/testdata/sf0.001"


def slow_chunks(text):
    """The same chunks from the definition: each boundary from the hashes of the last two lines alone."""
    parts = text.encode().split(b"\n")
    turn = lambda h: (h << 1 | h >> 63) & (2**64 - 1)
    hashes = [xxhash.xxh64_intdigest(p) for p in parts]
    begin, found = 0, []
    for i in range(len(parts)):
        rolling = (turn(hashes[i - 1]) if i else 0) ^ hashes[i]
        n = i + 1 - begin
        if n >= 12 or (n >= 2 and rolling % 3 == 0) or i == len(parts) - 1:
            if sum(bool(p.strip()) for p in parts[begin:i + 1]) > 1:
                found.append((begin, tuple(parts[begin:i + 1])))
            begin = i + 1
    return found


def slow(rows):
    """Kept text per distinct row."""
    order = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    seen, kept = set(), {r: r[1] for r in rows}
    for row in order:
        parts, gone = row[1].encode().split(b"\n"), set()
        for begin, chunk in slow_chunks(row[1]):
            if chunk in seen:
                gone.update(range(begin, begin + len(chunk)))
            seen.add(chunk)
        kept[row] = b"\n".join(p for i, p in enumerate(parts) if i not in gone).decode()
    return kept


def check(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    kept = slow(rows)
    sha = lambda t: None if t is None else hashlib.sha256(t.encode()).hexdigest()
    want = [(d, sha(kept[(d, t)])) for d, t in rows]
    got = [(r.doc_id, r.kept_sha256) for r in lines.line_dedup(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    return sum(kept[r] != r[1] for r in rows)


def test_whole_table_equals_brute_force(spark):
    assert check(spark.read.parquet(f"{FOLDER}/documents.parquet")) > 0


def test_odd_rows(docs_of):
    rng = random.Random(5)
    pool = [f"line {i} of the pool" for i in range(60)] + ["", "  ", "\r", "é\x0b"]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.3 else pool[(i + k) % 60] for k in range(rng.randrange(0, 40)))) for i in range(60)]
    passage = "\n".join(pool[10:40])
    rows += [(100, passage + "\n" + passage), (101, "shift\n" + passage), (101, "shift\n" + passage), (None, passage), (102, None), (103, ""),
             (104, "\n\n\n"), (105, "\n".join(f"long {i % 3000}" for i in range(20_000))), (106, "one line"), (107, "one line")]
    df = docs_of(rows, at="1", hash="2", pieces="3", _id="4")
    assert check(df) > 10


def test_rows_and_columns_stay(docs_of):
    passage = "\n".join(f"sentence number {i}." for i in range(30))
    df = docs_of([(1, "start\n" + passage), (2, passage + "\nend"), (3, None)], cut="5", _row="6")
    out = lines.without_repeated_lines(df)
    assert out.columns == df.columns and out.schema == df.schema
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "start\n" + passage and got[3].text is None
    assert len(got[2].text) < 0.4 * len(passage) and got[2].text.endswith("end") and got[2].n_chars == len(got[2].text)


def test_unequal_chunks_of_one_hash_stay(docs_of, monkeypatch):
    """Every chunk gets one hash in the comparison; only equal bytes go."""
    from pyspark.sql import functions as F
    real = lines.line_chunks
    monkeypatch.setattr(lines, "line_chunks", lambda c: F.transform(real(c), lambda p: F.struct(p["at"].alias("at"), p["n"].alias("n"), F.lit(1).cast("bigint").alias("hash"))))
    rows = [(1, "a a\nb b"), (2, "c c\nd d"), (3, "a a\nb b")]
    got = {r.doc_id: r.text for r in lines.without_repeated_lines(docs_of(rows)).collect()}
    assert got == {1: "a a\nb b", 2: "c c\nd d", 3: ""}


def test_empty_table(docs_of):
    assert lines.line_dedup(docs_of([])).count() == 0


def test_boundaries_return_after_an_insertion():
    hashes = [xxhash.xxh64_intdigest(f"line {i}".encode()) for i in range(300)]
    ends = set(lines.boundaries(hashes))
    moved = {e - 1 for e in lines.boundaries([12345, *hashes])}
    assert len(ends & moved) > 0.8 * len(ends)


def test_texts_travel_once(spark, docs_of):
    """No join fetches the bytes of first places: the only exchange of texts is the one that cuts them."""
    passage = "\n".join(f"sentence number {i}." for i in range(30))
    out = lines.line_dedup(docs_of([(i, f"start {i}\n{passage}") for i in range(50)]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "first-chunks" not in " ".join(out.inputFiles()) and "bytes" not in plan
    assert sum(r.n_removed_lines > 0 for r in out.collect()) == 49
