import re
from collections import defaultdict

import duckdb

from clickloom.llm import quality

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = defaultdict(list)
    for i in range(len(words) - 7):
        grams[tuple(words[i:i + 8])].append(i)
    repeated = {k for at in grams.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, r = len(words), len(repeated)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n


def test_whole_table_equals_sql(spark):
    got = quality.quality(spark.read.parquet(f"{FOLDER}/documents.parquet")).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = con.execute(quality.SQL).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = lambda df: df[columns].sort_values(columns).reset_index(drop=True).astype(str)
    assert order(got).equals(order(want))


def test_base_measures_of_odd_texts(docs_of):
    period = " ".join(f"p{i % 9}" for i in range(200))
    texts = [None, "", " \t\n", "a", "x " * 7, "x " * 8, "x " * 9, "x " * 30, period, period + " end\n" + period,
             "a # b | c\na # b | c\r\na # b | c\n\n", " ".join(f"w{i}" for i in range(50)),
             "é" * 100 + " ü\x0b\x0cß", " ".join(f"w{i % 5000}" for i in range(30_000)), "   x"]
    rows = docs_of([(i, t, None, "s") for i, t in enumerate(texts)], _host="1", words="2", lines="3", kept="4")
    got = {r.doc_id: tuple(r)[1:7] for r in quality.quality(rows).collect()}
    assert got == {i: slow_base(t) for i, t in enumerate(texts)}


def test_frequent_lines_deplete_documents_but_copies_do_not(docs_of):
    coded = lambda i: "".join(chr(97 + int(c)) for c in str(i))  # noqa: E731  digits count as alike
    words = lambda name, n: " ".join(f"{name}w{coded(i)}" for i in range(n))
    menu, body = words("menu", 25), words("copied", 40)
    rows = [(i, f"{menu}\n{words(f'own{coded(i)}', 5)}", None, "a") for i in range(150)]           # little is left
    rows += [(200 + i, f"{menu}\n{words(f'long{coded(i)}', 80)}", None, "a") for i in range(20)]   # enough is left
    rows += [(300 + i, f"{body}\n{words('more', 30)}\n{words('third', 30)}" + (f"\nedit{coded(i)}" if i % 9 == 0 else ""), None, "a") for i in range(150)]
    rows += [(500, f"{menu}\n{words('other', 5)}", None, "b"), (501, menu, None, None), (502, None, None, None), (None, menu, None, "a")]
    df = docs_of(rows, _n="1")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    want = {*range(200, 220), *range(300, 450), 500, 501}
    assert {r.doc_id for r in kept.collect()} == want
    assert {r.doc_id for r in quality.quality(df).where("kept").collect()} == want


def test_effective_documents(docs_of):
    """Three copies each of forty documents that share a line count as forty."""
    rows = [(i, f"shared line here\nown {chr(97 + i % 40 % 20) * (1 + i % 40 // 20)}", None, "h") for i in range(120)]
    for limit, left in ((39, 2), (41, 5)):
        kept = quality.quality(docs_of(rows), documents=limit, share=0).select("n_words_left").distinct().collect()
        assert [r[0] for r in kept] == [left]


def test_texts_without_frequent_lines(docs_of):
    """The shared line goes in any spelling that is normalised to it, on its host only; other lines stay byte for byte."""
    coded = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    rows = [(i, f"Home  About {i % 10}\n\n  own{coded(i)} text\n", None, "a") for i in range(120)]
    rows += [(500, "home about 7\nhere", None, "b"), (501, None, None, "a"), (502, "\tHOME about 3 ", None, "a"), (503, "", None, "a")]
    df = docs_of(rows, _left="1", frequent="2", _row="3")
    out = quality.without_frequent_lines(df)
    assert out.schema == df.schema
    want = {i: f"\n  own{coded(i)} text\n" for i in range(120)} | {500: "home about 7\nhere", 501: None, 502: "", 503: ""}
    got = {r.doc_id: r for r in out.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())


def test_empty_table(docs_of):
    assert quality.quality(docs_of([])).count() == 0
