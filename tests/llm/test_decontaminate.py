import duckdb

from clickloom.llm import decontaminate

FOLDER = "/root/testdata/sf0.001"
ITEM = "A train leaves Berlin at 9 and drives 300 km to Hamburg with 80 people while Anna waits 45 minutes for the next one"
SHORT = "what is the sum of all the odd numbers below 90"


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_whole_table_equals_sql(spark):
    read = lambda t: spark.read.parquet(f"{FOLDER}/{t}.parquet")
    got = decontaminate.contaminated(read("documents"), read("benchmark")).toPandas().sort_values("doc_id")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.execute(decontaminate.SQL).df().sort_values("doc_id")
    assert got.contaminated.any() and not got.contaminated.all()
    assert got[sorted(got)].values.tolist() == want[sorted(want)].values.tolist()


def test_template(docs_of):
    rows = decontaminate.windowed(docs_of([(1, ITEM + ".")]).selectExpr("text AS _text"))
    assert rows.first().template == (
        "a train leaves #name at #number and drives #number #unit to #name with #number people while #name waits #number #unit for the next one").split()


def cases(spark, docs_of, monkeypatch=None):
    new = ITEM.replace("Berlin", "Paris").replace("Hamburg", "Lyon").replace("300", "420").replace("80", "7").replace("45", "30").replace("Anna", "Marie")
    rows = [
        (1, "Some text before it. " + ITEM + " and text after it that goes on."),
        (2, "- " + new.replace("420 km", "420 miles") + "."),
        (3, new.replace("7 people", "420 people")),                    # two numbers became one
        (4, " ".join(ITEM.split()[:12]) + " but then something else happens to all of them"),
        (5, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 Anna Berlin"),
        (6, None), (7, ""), (8, ITEM), (8, ITEM), (None, "x " + ITEM),
        (9, "Tell me: " + SHORT.replace("90", "12,000") + "?"),
        (10, "what is the sum of all the even numbers below 90"),
    ]
    return docs_of(rows, item="1", words="2", hash="3", _items="4"), bench(spark, [(1, ITEM), (2, SHORT), (3, None), (4, "too short"), (1, SHORT)])


def test_cases(spark, docs_of):
    docs, items = cases(spark, docs_of)
    got = [tuple(r) for r in decontaminate.contaminated(docs, items).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 1, True), (2, 1, True), (3, 0, False), (4, 0, False), (5, 0, False), (6, 0, False), (7, 0, False), (8, 1, True), (8, 1, True),
        (None, 1, True), (9, 2, True), (10, 0, False)], key=str)
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7, 10]


def test_shuffled_join_gives_the_same(spark, docs_of, monkeypatch):
    docs, items = cases(spark, docs_of)
    want = sorted(map(str, decontaminate.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(map(str, decontaminate.contaminated(docs, items).collect())) == want


def test_empty_tables(spark, docs_of):
    assert decontaminate.contaminated(docs_of([]), bench(spark, [(1, ITEM)])).count() == 0
    assert decontaminate.clean(docs_of([(1, ITEM)]), bench(spark, [])).count() == 1


LISTED = "The table lists 14 , 15 , 16 , 17 and 18 for Anna , Bert , Carl and Dora"
BELOW = "How many primes lie below ninety seven?"
ASKED = "how many primes lie below 97"
HARD = [
    (1, f"He said, {LISTED} . More follows"), (2, LISTED.replace("16", "61")), (3, "1 , 2 , 3 , 4 " * 30),
    (4, f"They asked: {BELOW.upper()} Nobody knew"), (5, BELOW.replace("seven", "eight")),
    (6, "so: how many primes lie below 1,000? Many"), (7, "how many primes lie above 97"), (8, "too short"), (9, "it is too short"),
    (10, "Too short."), (11, None), (12, " \n"), (13, BELOW), (13, BELOW), (14, "12 45 78"), (15, "12 45 79"), (16, "x " * 50_000 + LISTED),
    (17, "between 3 and 3 lie none here"), (18, "between 3 and 5 lie none here"), (19, "between 5 and 8 lie none here"),
]
HARD_ITEMS = [(1, LISTED), (2, BELOW), (3, ASKED), (4, "too short"), (5, None), (6, ""), (7, "12 45 78"), (8, "Between 7 and 9 lie none here")]
HARD_FOUND = {1: 1, 4: 1, 6: 1, 8: 1, 10: 1, 13: 1, 14: 1, 16: 1, 18: 1, 19: 1}


def test_short_and_number_heavy_items_are_found_as_a_whole(spark, docs_of, monkeypatch):
    docs, items = docs_of(HARD), bench(spark, HARD_ITEMS)
    for limit in (decontaminate.BROADCAST_WINDOWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
        got = [(r.doc_id, r.n_items) for r in decontaminate.contaminated(docs, items).collect()]
        assert sorted(got) == sorted((i, HARD_FOUND.get(i, 0)) for i, _ in HARD)


def test_whole_items_equal_sql(spark, docs_of):
    rows = [r for k, r in enumerate(HARD) if r[0] != 16 and (not k or HARD[k - 1][0] != r[0])]
    docs, items = docs_of(rows), bench(spark, HARD_ITEMS)
    con = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", items)):
        con.register(name, df.toPandas())
    want = con.execute(decontaminate.SQL).df().sort_values("doc_id")
    got = decontaminate.contaminated(docs, items).toPandas().sort_values("doc_id")
    assert got[sorted(got)].values.tolist() == want[sorted(want)].values.tolist()


def test_lenient_slots_may_become_equal(spark, docs_of):
    docs, items = cases(spark, docs_of)
    found = lambda strict: sorted(r.doc_id for r in decontaminate.contaminated(docs, items, strict).collect() if r.contaminated and r.doc_id)
    assert found(False) == sorted([*found(True), 3])
