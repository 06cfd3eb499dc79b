"""Benchmark decontamination by templates, with DataFrame functions only.

Texts become templates: words in lower case without marks around them, numbers, names (capitalised words that follow a
word or comma) and units (after a number) replaced by typed placeholders. Windows of ``WINDOW`` template words of the
benchmark are joined by hash with those of the documents, and the windows of one item in one document at one shift are
taken together: what the placeholders stand for must correspond one to one, as it does when a question is asked with
other numbers or names. A document is contaminated by an item if enough of its windows match so.

Windows that hold fewer than ``LITERALS`` plain words say too little as templates. Items with at most ``NEEDED`` windows
that say enough (short ones, and those made of numbers, units and names) are therefore also looked for as a whole: a
document holds such an item if all its words follow each other there, marks and case aside. An item of fewer than
``ANCHOR`` words must be the whole document. Items shorter than a window that have ``LITERALS`` plain words may have other
numbers, units or names, again one to one. One run of ``ANCHOR`` words of an item, the one with the most plain words, is
joined by hash with all runs of the documents; the rest is compared in place.

Both sides of the benchmark are broadcast while they have at most ``BROADCAST_WINDOWS`` rows, beyond it the joins are
shuffled ones. With ``strict=False`` slots are judged by window, and different values may become the same one.

Defined results: null texts and items have no words and match nothing; repeated rows get equal results; a repeated item
counts once per row; an empty benchmark contaminates nothing; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.base import KEY, keyed
from clickloom.llm.quality import words_of
from clickloom.session import materialize

WINDOW, LITERALS = 8, 5
NEEDED = 6                       # matching windows, or all of an item that has fewer
ANCHOR, ANCHOR_WORDS = 4, 2      # words of a run that is joined, and how many of them tell more than numbers do
BROADCAST_WINDOWS = 500_000      # of some 100 bytes
MARKS = ".,;:!?()[]{}<>\"'`*_~|-–—…«»“”‘’¿¡"
NUMBER, NAME, UNIT = "#number", "#name", "#unit"
UNITS = ("km m cm mm mi mile miles ft feet inch inches yd yards kg g mg lb lbs oz ton tons l ml cl gallon gallons h hr hrs hour hours min mins "
         "minute minutes s sec second seconds day days week weeks month months year years % percent $ € £ dollar dollars euro euros cent "
         "cents kmh mph °c °f degrees watt watts volts joule joules stunden tage jahre minuten heures jours ans minutos horas días años").split()


def bare(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(MARKS)))


def number(bare_word: Column) -> Column:
    return (bare_word >= "0") & (bare_word < ":")


def plain(shape: Column) -> Column:
    return F.size(F.filter(shape, lambda t: ~t.startswith("#") & (t != "")))


def with_template(df: DataFrame, *kept: str) -> DataFrame:
    """Adds the template words ``template`` of ``words`` as written, and ``bare`` if asked for; each word is stripped once."""

    def word(x: Column, before: Column) -> Column:
        w, b, first = x["w"], x["b"], F.substring(x["w"], 1, 1)
        named = (F.lower(first) != first) & F.substring(before["w"], -1, 1).rlike(r"[\p{L},]") & w.rlike(r"^\p{Lu}\p{Ll}")
        return F.when(number(b), NUMBER).when(named, NAME).when(number(before["b"]) & b.isin(UNITS), UNIT).otherwise(b)

    nothing = F.array(F.struct(F.lit("").alias("w"), F.lit("").alias("b")))
    df = df.withColumn("both", F.transform("words", lambda w: F.struct(w.alias("w"), bare(w).alias("b"))))
    before = F.slice(F.concat(nothing, "both"), 1, F.size("both"))
    df = df.withColumn("template", F.zip_with("both", before, word))
    return df.withColumns({name: F.col("both.b") for name in kept}).drop("both")


def windowed(rows: DataFrame, *kept: str) -> DataFrame:
    """Adds ``words``, ``template`` and ``windows`` (the hash of the template words from each place on) to ``_text``."""
    later = lambda name, k: F.slice(name, k + 1, F.greatest(F.size(name), F.lit(1)))
    paired = lambda name, k: F.zip_with(name, later(name, k), lambda a, b: F.xxhash64(a, b))
    df = with_template(rows.withColumn("words", words_of(F.col("_text"))).drop("_text"), *kept)
    df = df.withColumn("w1", F.transform("template", lambda w: F.xxhash64(w)))
    df = df.withColumn("w2", paired("w1", 1)).withColumn("w4", paired("w2", 2))
    windows = F.slice(paired("w4", 4), 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))
    return df.withColumn("windows", windows).drop("w1", "w2", "w4")


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.monotonically_increasing_id().alias("item"), F.coalesce("text", F.lit("")).alias("_text"))
    return materialize(windowed(items, "bare"), "benchmark-items")


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(hash, item, at, shape, meant, needed) of the windows that say enough."""
    spread = items.select("item", "words", "template", F.posexplode_outer("windows").alias("at", "hash"))
    spread = spread.select("item", "at", "hash", F.slice("template", F.col("at") + 1, WINDOW).alias("shape"), F.slice("words", F.col("at") + 1, WINDOW).alias("meant"))
    spread = spread.where((F.size("shape") == WINDOW) & (plain(F.col("shape")) >= LITERALS))
    counts = spread.groupBy("item").agg(F.least(F.count("*"), F.lit(NEEDED)).alias("needed"), F.count("*").alias("telling"))
    return materialize(spread.join(counts, "item"), "benchmark-windows")


def anchored(rows: DataFrame, *columns: str) -> DataFrame:
    """(columns, place, key) of all runs of ``ANCHOR`` words; of fewer words, of the only run there is."""
    def run_at(place: Column) -> Column:
        run = F.slice("bare", place + 1, ANCHOR)
        told = F.transform(run, lambda b: F.when(number(b), NUMBER).otherwise(b))
        # Runs of numbers are everywhere in tables, so these are told apart by their values.
        telling = F.size(F.filter(told, lambda t: t != NUMBER)) >= ANCHOR_WORDS
        return F.struct(place.alias("place"), F.xxhash64(F.when(telling, told).otherwise(run)).alias("key"))

    places = F.sequence(F.lit(0), F.greatest(F.size("bare") - ANCHOR, F.lit(0)))
    return rows.where(F.size("bare") > 0).select(*columns, F.inline(F.transform(places, run_at)))


def whole_items(items: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, item, at, item_bare, item_template) of the items that few windows tell."""
    enough = windows.where(F.col("telling") > NEEDED).select("item").distinct()
    spread = anchored(items.join(enough, "item", "left_anti"), "item", "bare", "template")
    said = plain(F.slice("template", F.col("place") + 1, ANCHOR))
    best = spread.groupBy("item", "bare", "template").agg(F.max_by(F.struct("key", "place"), F.struct(said, -F.col("place"))).alias("a"))
    return materialize(best.select("a.key", "item", F.col("a.place").alias("at"), F.col("bare").alias("item_bare"), F.col("template").alias("item_template")), "whole-items")


def whole_matches(rows: DataFrame, wanted: DataFrame, small: bool) -> DataFrame:
    """(_id, _h, item) of the documents that hold an item as a whole.

    Places are found without their texts, which are read again where an item may stand.
    """
    docs = with_template(rows.select(*KEY, words_of(F.col("_text")).alias("words")), "bare").drop("words")
    near = wanted.select("key", "item", "at")
    places = anchored(docs, *KEY).join(F.broadcast(near) if small else near, "key")
    places = materialize(places.select(*KEY, "item", (F.col("place") - F.col("at")).alias("first")).where("first >= 0").distinct(), "whole-places")
    texts = materialize(docs.join(places.select(*KEY).distinct(), KEY, "left_semi").dropDuplicates(KEY), "whole-texts")
    first, length = F.col("first"), F.size("item_bare")
    met = places.join(texts, KEY).join(wanted.drop("key", "at"), "item")
    met = met.where((first + length <= F.size("bare")) & ((length >= ANCHOR) | (length == F.size("bare"))))
    met = met.select(*KEY, "item", "item_bare", "item_template",
                     F.slice("bare", first + 1, length).alias("bare"), F.slice("template", first + 1, length).alias("template"))
    zipped = F.arrays_zip(F.col("item_template").alias("t"), F.col("item_bare").alias("m"), F.col("template").alias("u"), F.col("bare").alias("s"))
    alike = F.forall(zipped, lambda x: (x["t"] == x["u"]) | (x["m"] == x["s"]))
    changed = (length < WINDOW) & (plain(F.col("item_template")) >= LITERALS) & alike & one_to_one(slots(F.col("item_template"), F.col("item_bare"), F.col("bare")))
    return met.where((F.col("bare") == F.col("item_bare")) | changed).select(*KEY, "item")


def slots(shape: Column, meant: Column, seen: Column) -> Column:
    """(type, meant value, seen value) of the placeholders in a window."""
    zipped = F.arrays_zip(shape.alias("t"), meant.alias("m"), seen.alias("s"))
    typed = F.filter(zipped, lambda x: x["t"].isin(NUMBER, NAME, UNIT))
    return F.transform(typed, lambda x: F.struct(x["t"].alias("t"), bare(x["m"]).alias("m"), bare(x["s"]).alias("s")))


def kinds(pairs: Column, name: str) -> Column:
    return F.size(F.array_distinct(F.transform(pairs, lambda x: F.struct(x["t"], x[name]))))


def one_to_one(pairs: Column) -> Column:
    """Whether distinct values of a type stand for distinct values."""
    n = F.size(F.array_distinct(pairs))
    return (n == kinds(pairs, "m")) & (n == kinds(pairs, "s"))


def contaminations(rows: DataFrame, benchmark: DataFrame, strict: bool = True) -> DataFrame:
    """(_id, _h, item) of the documents, rows (_id, _h, _text), that hold an item; some more than once."""
    items = benchmark_items(benchmark)
    wanted = benchmark_windows(items)
    small = wanted.count() <= BROADCAST_WINDOWS
    # The outer form keeps Spark from filtering on the windows' number below, where their whole expression would be repeated.
    spread = windowed(rows.select(*KEY, "_text")).select(*KEY, "words", F.posexplode_outer("windows").alias("place", "hash"))
    seen = F.slice("words", F.col("place") + 1, WINDOW)
    if small:
        met = spread.join(F.broadcast(wanted), "hash").withColumn("seen", seen)
    else:      # a shuffle must not copy the whole text with each window
        met = spread.select(*KEY, "place", "hash", seen.alias("seen")).join(wanted, "hash")
    met = met.select(*KEY, "item", "at", "needed", (F.col("place") - F.col("at")).alias("shift"),
                     slots(F.col("shape"), F.col("meant"), F.col("seen")).alias("slots"))
    if not strict:
        met = met.where(F.size(F.array_distinct("slots")) == kinds(F.col("slots"), "m"))
    # An item has a bounded number of windows, so these groups are small however many documents hold it.
    shifts = met.groupBy(*KEY, "item", "shift", "needed").agg(
        F.collect_set("at").alias("at"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    fitting = shifts.where(one_to_one(F.col("slots"))) if strict else shifts
    found = fitting.groupBy(*KEY, "item", "needed").agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("windows"))
    found = found.where("windows >= needed").select(*KEY, "item")
    whole = whole_items(items, wanted)
    n = whole.count()
    return found.unionByName(whole_matches(rows, whole, n <= BROADCAST_WINDOWS)) if n else found


def with_contamination(docs: DataFrame, benchmark: DataFrame, strict: bool = True) -> DataFrame:
    rows = keyed(docs)
    found = contaminations(rows, benchmark, strict).groupBy(*KEY).agg(F.countDistinct("item").alias("_items"))
    return rows.select("_row", *KEY).join(materialize(found, "contaminated"), KEY, "left")


def contaminated(docs: DataFrame, benchmark: DataFrame, strict: bool = True) -> DataFrame:
    """Per row: doc_id, the number of benchmark rows it holds, and whether there is one."""
    items = F.coalesce("_items", F.lit(0))
    only = docs.select("doc_id", "text")
    return with_contamination(only, benchmark, strict).select(
        F.col("_row.doc_id").cast("bigint").alias("doc_id"), items.cast("bigint").alias("n_items"), (items > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, strict: bool = True) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    return with_contamination(docs, benchmark, strict).where(F.col("_items").isNull()).select("_row.*")


_MARKS_SQL = MARKS.replace("'", "''")
_TEMPLATES = """
{name}_words AS (
  SELECT {key} AS k, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM {table}
), {name}_tokens AS (
  SELECT k, i, w, lag(w, 1, '') OVER (PARTITION BY k ORDER BY i) AS v FROM (SELECT k, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM {name}_words)
), {name}_bare AS (
  SELECT *, lower(trim(w, '{marks}')) AS b, lower(trim(v, '{marks}')) AS c FROM {name}_tokens
), {name}_template AS (
  SELECT k, i, b, CASE WHEN b >= '0' AND b < ':' THEN '#number'
    WHEN lower(left(w, 1)) <> left(w, 1) AND regexp_matches(right(v, 1), '[\\p{{L}},]') AND regexp_matches(w, '^\\p{{Lu}}\\p{{Ll}}') THEN '#name'
    WHEN b IN ({units}) AND c >= '0' AND c < ':' THEN '#unit' ELSE b END AS t FROM {name}_bare
), {name}_windows AS (
  SELECT k, i, list(t) OVER w AS shape, list(b) OVER w AS vals FROM {name}_template
  WINDOW w AS (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
)"""


def _templates(name: str, table: str, key: str) -> str:
    return _TEMPLATES.format(name=name, table=table, key=key, marks=_MARKS_SQL, units=", ".join(f"'{u}'" for u in UNITS))


SQL = f"""
WITH {_templates("d", "documents", "doc_id").strip()}, {_templates("b", "benchmark", "item_id").strip()},
wanted AS (
  SELECT k AS item, i AS pos, shape, vals, least(6, count(*) OVER (PARTITION BY k)) AS needed FROM b_windows
  WHERE len(shape) = 8 AND len(list_filter(shape, lambda t: NOT starts_with(t, '#') AND t <> '')) >= 5
), met AS (
  SELECT d.k, item, pos, needed, d.i - pos AS shift, wanted.vals AS m, d.vals AS s, wanted.shape AS shape FROM d_windows d JOIN wanted USING (shape)
), slots AS (
  SELECT DISTINCT k, item, shift, shape[j] AS t, m[j] AS m, s[j] AS s FROM (SELECT *, unnest(range(1, 9)) AS j FROM met)
  WHERE shape[j] IN ('#number', '#name', '#unit')
), unfit AS (
  SELECT k, item, shift FROM slots GROUP BY ALL HAVING count(*) <> count(DISTINCT (t, m)) OR count(*) <> count(DISTINCT (t, s))
), found AS (
  SELECT k, item FROM met ANTI JOIN unfit USING (k, item, shift) GROUP BY k, item, needed HAVING count(DISTINCT pos) >= needed
), d_whole AS (
  SELECT k, list(b ORDER BY i) AS bs, list(t ORDER BY i) AS ts, count(*) AS n FROM d_template GROUP BY k
), b_whole AS (
  SELECT k AS item, list(b ORDER BY i) AS bs, list(t ORDER BY i) AS ts, count(*) AS n,
    len(list_filter(list(t ORDER BY i), lambda t: NOT starts_with(t, '#') AND t <> '')) AS said
  FROM b_template GROUP BY k HAVING k NOT IN (SELECT item FROM wanted GROUP BY item HAVING count(*) > 6)
), tried AS (
  SELECT d.k, item, d.n AS d_n, b.n, said, b.bs AS m, b.ts AS t, unnest(range(1, d.n - b.n + 2)) AS p, d.bs, d.ts FROM d_whole d JOIN b_whole b ON d.n >= b.n
), cut AS (
  SELECT k, item, d_n, n, said, m, t, list_slice(bs, p, p + n - 1) AS s, list_slice(ts, p, p + n - 1) AS u FROM tried WHERE n >= 4 OR n = d_n
), shown AS (
  SELECT *, list_filter(list_zip(t, m, s), lambda x: x[1] IN ('#number', '#name', '#unit')) AS held FROM cut
  WHERE m = s OR n < 8 AND said >= 5 AND len(list_filter(list_zip(t, u, m, s), lambda x: x[1] <> x[2] AND x[3] <> x[4])) = 0
), whole AS (
  SELECT DISTINCT k, item FROM shown WHERE m = s OR len(list_distinct(held)) = len(list_distinct(list_transform(held, lambda x: [x[1], x[2]])))
    AND len(list_distinct(held)) = len(list_distinct(list_transform(held, lambda x: [x[1], x[3]])))
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_items, coalesce(n, 0) > 0 AS contaminated
FROM documents LEFT JOIN (SELECT k AS doc_id, count(DISTINCT item) AS n FROM (FROM found UNION FROM whole) GROUP BY 1) USING (doc_id)
"""
