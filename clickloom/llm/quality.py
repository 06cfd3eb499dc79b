"""Quality rules by cross-document line frequency, with DataFrame functions only.

Every normalised line is hashed. Per host (``source``) it counts the documents that hold the line; documents that differ
in little else count as one, since copies are the business of near-duplicate removal: a document is told apart by the
least hash among its *other* lines, and the count is the effective number (sum n)^2 / sum n^2 of these contexts. Lines
above both limits count as taken out, and documents of which too little is left are rejected; ``without_frequent_lines``
gives the texts without them.

Defined results: a null text has no words and fails; a null source is a host of its own; repeated rows are copies of one
document and get equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.base import text_of
from clickloom.session import materialize

SPACE = " \t\n\x0b\f\r"
SPACES, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30   # words; percent of words in repeated windows
LINE_DOCUMENTS, LINE_SHARE = 100, 0.001   # limits of a line: documents of its host, share of the host's documents
LEAST_LEFT = 30                       # percent of the words that must stay


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def normalised(line: Column) -> Column:
    spaced = F.regexp_replace(F.btrim(F.lower(line), F.lit(SPACE)), SPACES, " ")
    return F.translate(spaced, "123456789", "000000000")


def word_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def with_repeats(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words from ``words``: hashes of 1, 2, 4 and 8 words, each from two of the former."""
    later = lambda name, k: F.slice(name, k + 1, F.greatest(F.size(name), F.lit(1)))
    paired = lambda name, k: F.zip_with(name, later(name, k), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("w1", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("w2", paired("w1", 1)).withColumn("w4", paired("w2", 2))
    df = df.withColumn("w8", F.slice(paired("w4", 4), 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))))
    placed = F.sort_array(F.transform("w8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("z", F.when(F.size(F.array_distinct("w8")) < F.size("w8"), placed))
    twins = F.zip_with("z", later("z", 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("at", F.sort_array(F.array_distinct(F.flatten(twins))))
    covered = F.zip_with("at", later("at", 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0).cast("bigint"), lambda x, y: x + y)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("bigint"))).drop("w1", "w2", "w4", "w8", "z", "at")


def measured(rows: DataFrame) -> DataFrame:
    """Base measures of rows (``_text``, ``_host``, ...) and their lines as (hash, words)."""
    df = rows.withColumn("words", words_of(F.col("_text"))).withColumn("lines", word_lines(F.col("_text")))
    df = with_repeats(df)
    n_words = F.size("words").cast("bigint")
    kept = [c for c in rows.columns if c != "_text"]
    return df.select(
        *kept,
        n_words.alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        ((n_words < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > n_words * MOST_REPEATED)).alias("base_failed"),
        hashed("lines").alias("lines"),
    )


def hashed(lines: Column | str) -> Column:
    """(hash, words) of each line."""
    return F.transform(lines, lambda line: F.struct(F.md5(normalised(line)).alias("h"), F.regexp_count(line, F.lit(WORD + "+")).alias("w")))


def frequent_lines(rows: DataFrame, documents: int = LINE_DOCUMENTS, share: float = LINE_SHARE) -> DataFrame:
    """(host, line hash) of the lines above the limits."""
    hashes = F.array_distinct(F.transform("lines", lambda x: x["h"]))
    each = rows.select("_host", hashes.alias("hs")).withColumn("first", F.slice(F.sort_array("hs"), 1, 2))
    each = each.select("_host", F.explode("hs").alias("h"), F.get("first", 0).alias("m1"), F.get("first", 1).alias("m2"))
    context = F.when(F.col("h") == F.col("m1"), F.coalesce("m2", F.lit(""))).otherwise(F.col("m1"))
    alike = each.groupBy("_host", "h", context.alias("context")).agg(F.count("*").cast("double").alias("n"))
    total = F.sum("n")
    lines = alike.groupBy("_host", "h").agg((total * total / F.sum(F.col("n") * F.col("n"))).alias("documents"))
    hosts = rows.groupBy("_host").agg(F.count("*").alias("rows"))
    above = lines.where(F.col("documents") > documents).join(hosts, "_host")
    return above.where(F.col("documents") > F.col("rows") * share).select("_host", "h")


def with_host(docs: DataFrame) -> DataFrame:
    """The rows as ``_row`` with ``_text`` and ``_host``."""
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    host = F.coalesce(F.concat(F.lit("="), F.col("_row.source").cast("string")), F.lit(""))
    return packed.select("_row", text_of(F.col("_row.text")).alias("_text"), host.alias("_host"))


def verdict(df: DataFrame, gone: Column) -> DataFrame:
    left = F.col("n_words") - F.coalesce(gone, F.lit(0))
    enough = (left >= LEAST_WORDS) & (left * 100 >= F.col("n_words") * LEAST_LEFT)
    return df.withColumn("n_words_left", left).withColumn("kept", ~F.col("base_failed") & enough)


def quality(docs: DataFrame, documents: int = LINE_DOCUMENTS, share: float = LINE_SHARE) -> DataFrame:
    """Per row its doc_id, measures, base verdict, words left without frequent lines, and the verdict ``kept``.

    The texts are read once; their lines' hashes and their measures are written and all that follows reads those.
    """
    doc_id = F.col("_row.doc_id").cast("bigint").alias("doc_id")
    rows = with_host(docs).select(doc_id, "_text", "_host", F.monotonically_increasing_id().alias("_n"))
    rows = materialize(measured(rows), "line-hashes")
    above = materialize(frequent_lines(rows, documents, share), "frequent-lines")
    lines = rows.select("_n", "_host", F.explode("lines").alias("x")).select("_n", "_host", F.col("x.h").alias("h"), F.col("x.w").alias("w"))
    gone = lines.join(above, ["_host", "h"], "left_semi").groupBy("_n").agg(F.sum("w").alias("gone"))
    return verdict(rows.join(gone, "_n", "left"), F.col("gone")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_words_left", "kept",
    )


def frequent_by_host(rows: DataFrame, documents: int, share: float) -> DataFrame:
    """Per host of rows (``_text``, ``_host``) with such lines, the list ``frequent`` of the hashes of its frequent lines.

    Texts are neither written nor shuffled: frequent lines, at most a thousand times the lines of a document per host, come
    to the rows of their host as a list, by a join that Spark broadcasts while the written table is small.
    """
    hashes = materialize(rows.select("_host", hashed(word_lines(F.col("_text"))).alias("lines")), "line-hashes")
    above = frequent_lines(hashes, documents, share).groupBy("_host").agg(F.collect_list("h").alias("frequent"))
    return materialize(above, "frequent-lines")


def is_frequent(h: Column) -> Column:
    return F.coalesce(F.array_contains("frequent", h), F.lit(False))


def without_frequent_lines(docs: DataFrame, documents: int = LINE_DOCUMENTS, share: float = LINE_SHARE) -> DataFrame:
    """All rows of ``docs`` with the texts that are left without frequent lines, and ``n_chars`` following them where it is a
    column. Lines of white space alone stay, null texts stay null, and texts may become empty."""
    rows = with_host(docs)
    full = rows.join(frequent_by_host(rows, documents, share), "_host", "left")
    kept = F.filter(F.split("_text", "\n"), lambda line: ~(line.rlike(WORD) & is_frequent(F.md5(normalised(line)))))
    left = F.when(F.col("_row.text").isNotNull(), F.array_join(kept, "\n"))
    changed = full.withColumn("_left", F.when(F.col("frequent").isNull(), F.col("_row.text")).otherwise(left))
    given = {f.name: f.dataType for f in docs.schema}
    new = {"text": F.col("_left").cast(given["text"])}
    if "n_chars" in given:
        same = F.col("_left").eqNullSafe(F.col("_row.text"))
        new["n_chars"] = F.when(same, F.col("_row.n_chars")).otherwise(F.char_length("_left")).cast(given["n_chars"])
    return changed.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def keep_good(docs: DataFrame, documents: int = LINE_DOCUMENTS, share: float = LINE_SHARE) -> DataFrame:
    """The rows of ``docs`` that pass, whole and unchanged."""
    rows = with_host(docs)
    full = measured(rows).join(frequent_by_host(rows, documents, share), "_host", "left")
    common = F.filter("lines", lambda x: is_frequent(x["h"]))
    gone = F.aggregate(common, F.lit(0).cast("bigint"), lambda total, x: total + x["w"])
    # A row number in the condition keeps Spark from moving the filter below the measures, which would write them out
    # once for every mention.
    judged = verdict(full, gone).select("_row", "kept", F.monotonically_increasing_id().alias("_n"))
    return judged.where("kept AND _n >= 0").select("_row.*")


SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS host FROM documents
), worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM texts
), windows AS (
  SELECT n, i, list_slice(words, i, i + 7) AS g FROM (SELECT n, words, unnest(range(1, len(words) - 6)) AS i FROM worded)
), repeated AS (
  SELECT n, i, lead(i) OVER (PARTITION BY n ORDER BY i) AS j FROM (SELECT n, i, count(*) OVER (PARTITION BY n, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT n, sum(least(8, coalesce(j - i, 8))) AS n_repeat_words FROM repeated GROUP BY n
), lines AS (
  SELECT n, host, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS w,
         md5(translate(regexp_replace(trim(lower(l), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g'),
                       '123456789', '000000000')) AS h
  FROM (SELECT n, host, unnest(lines) AS l FROM worded)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY h) AS k FROM (SELECT DISTINCT n, host, h FROM lines)
), firsts AS (
  SELECT n, max(h) FILTER (k = 1) AS m1, max(h) FILTER (k = 2) AS m2 FROM placed GROUP BY n
), contexts AS (
  SELECT host, h, CASE WHEN h = m1 THEN coalesce(m2, '') ELSE m1 END AS context, count(*)::DOUBLE AS c
  FROM placed JOIN firsts USING (n) GROUP BY 1, 2, 3
), above AS (
  SELECT host, h FROM (SELECT host, h, sum(c) * sum(c) / sum(c * c) AS d FROM contexts GROUP BY 1, 2)
  JOIN (SELECT host, count(*) AS rows FROM texts GROUP BY 1) USING (host) WHERE d > 100 AND d > rows * 0.001
), gone AS (
  SELECT n, sum(w) AS gone FROM lines JOIN above USING (host, h) GROUP BY 1
), measured AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(words) - coalesce(gone, 0)::BIGINT AS n_words_left
  FROM worded LEFT JOIN covered USING (n) LEFT JOIN gone USING (n)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words_left >= 20 AND n_words_left * 100 >= n_words * 30 AS kept
FROM measured
"""
