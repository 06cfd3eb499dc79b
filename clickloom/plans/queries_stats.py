"""Feature statistics (I) on the Gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.constants import CATEGORICAL_FEATURES, FEATURE_GROUPS, GROUPED_FEATURES

from clickloom.operators import stats
from clickloom.operators.stats import ERFC_TERMS
from clickloom.plans.lake import Lake
from clickloom.plans.oracle import GOLD, GOLD_VALUES, STAR, r6
from clickloom.plans.queries_profile import everything
from clickloom.plans.registry import query

GROUP_SQL = "CASE " + " ".join(
    f"WHEN feature IN ({', '.join(repr(c) for c in columns)}) THEN '{name}'" for name, columns in FEATURE_GROUPS.items()
) + " END"
CORR_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(click AS DOUBLE)) AS r FROM gold" for c in GROUPED_FEATURES)


@query("i01_correlation", f"""WITH {GOLD}, c AS ({CORR_LONG}), g AS (SELECT feature, r, {GROUP_SQL} AS "group" FROM c)
       SELECT feature, "group", {r6('r')} AS r, row_number() OVER (PARTITION BY "group" ORDER BY abs(r) DESC, feature) AS position FROM g""")
def _(lake: Lake) -> DataFrame:
    return everything(stats.ranked_correlation(lake.gold).withColumn("position", F.col("position").cast("bigint")))


PAIRS_LONG = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM gold"
    for i, a in enumerate(GROUPED_FEATURES) for b in GROUPED_FEATURES[i + 1:]
)


@query("i02_correlation_pairs", f"WITH {GOLD}, g AS MATERIALIZED (SELECT * FROM gold), c AS ({PAIRS_LONG.replace('FROM gold', 'FROM g')}) SELECT feature_a, feature_b, {r6('r')} AS r FROM c ORDER BY abs(c.r) DESC, 1, 2 LIMIT 15")
def _(lake: Lake) -> DataFrame:
    return everything(stats.correlation_pairs(lake.gold))


LEVELS = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS level, count(*) AS n, sum(click) AS pos FROM gold GROUP BY 2" for c in CATEGORICAL_FEATURES)
BINNED = "SELECT feature, CAST(floor(n_below * 64 / CAST(n_total AS DOUBLE)) AS VARCHAR) AS level, sum(n) AS n, sum(pos) AS pos FROM vals GROUP BY 1, 2"
MI = """tot AS (SELECT feature, CAST(sum(n) AS DOUBLE) AS tn, CAST(sum(pos) AS DOUBLE) AS tp FROM lv GROUP BY 1),
parts AS (SELECT feature,
  CASE WHEN pos > 0 THEN pos / tn * ln(pos * tn / (n * tp)) ELSE 0 END
  + CASE WHEN n - pos > 0 THEN (n - pos) / tn * ln((n - pos) * tn / (n * (tn - tp))) ELSE 0 END AS part FROM lv JOIN tot USING (feature)),
mi AS (SELECT feature, sum(part) AS mutual_info FROM parts GROUP BY 1)"""


@query("i03_information_categorical", f"WITH {GOLD}, lv AS ({LEVELS}), {MI} SELECT feature, {r6('mutual_info')} AS mutual_info FROM mi")
def _(lake: Lake) -> DataFrame:
    return everything(stats.mutual_information(stats.level_counts(lake.gold, CATEGORICAL_FEATURES)))


@query("i03_information_numeric", f"WITH {GOLD_VALUES}, lv AS ({BINNED}), {MI} SELECT feature, {r6('mutual_info')} AS mutual_info FROM mi")
def _(lake: Lake) -> DataFrame:
    values = stats.value_counts(lake.gold, GROUPED_FEATURES)
    return everything(stats.mutual_information(stats.quantile_level_counts(values)))


H = "h AS (SELECT -(p * ln(p) + (1 - p) * ln(1 - p)) AS entropy FROM (SELECT avg(click) AS p FROM gold))"


@query("i04_normalized_information", f"WITH {GOLD_VALUES}, lv AS ({BINNED}), {MI}, {H} SELECT feature, {r6('mutual_info')} AS mutual_info, {r6('mutual_info / entropy')} AS nmi FROM mi CROSS JOIN h")
def _(lake: Lake) -> DataFrame:
    values = stats.value_counts(lake.gold, GROUPED_FEATURES)
    info = stats.mutual_information(stats.quantile_level_counts(values))
    return everything(stats.normalized_information(info, lake.gold))


def _poly() -> str:
    out = "0.0::DOUBLE"
    for c in reversed(ERFC_TERMS):
        out = f"({out} * t + {c}::DOUBLE)"
    return out


RANK_TEST = f"""
s AS (SELECT feature, sum(CAST(pos AS DOUBLE) * ((n_below - pos_below) + (n - pos) / 2.0::DOUBLE)) AS u,
             sum(CAST(n AS DOUBLE) * n * n - n) AS ties, CAST(max(pos_total) AS DOUBLE) AS a, CAST(max(n_total) AS DOUBLE) AS n FROM vals GROUP BY 1),
z AS (SELECT *, greatest(abs(u - a * (n - a) / 2) - 0.5, 0) / sqrt(a * (n - a) / 12 * ((n + 1) - ties / (n * (n - 1)))) / sqrt(2.0::DOUBLE) AS x FROM s),
e AS (SELECT *, 1 / (1 + x / 2) AS t FROM z),
test AS (SELECT feature, u, least(t * exp({_poly()} - x * x), 1) AS p_value, 2 * u / (a * (n - a)) - 1 AS cliffs_delta FROM e)"""
EFFECT = "CASE WHEN abs(cliffs_delta) < 0.147 THEN 'Negligible' WHEN abs(cliffs_delta) < 0.33 THEN 'Small' WHEN abs(cliffs_delta) < 0.474 THEN 'Medium' ELSE 'Large' END"


@query("i05_rank_test", f"WITH {GOLD_VALUES},{RANK_TEST} SELECT feature, {r6('u')} AS u, {r6('p_value')} AS p_value FROM test")
def _(lake: Lake) -> DataFrame:
    return everything(stats.rank_test(stats.value_counts(lake.gold, GROUPED_FEATURES)).select("feature", "u", "p_value"))


@query("i06_cliffs_delta", f"""WITH {GOLD_VALUES},{RANK_TEST} SELECT feature, {r6('cliffs_delta')} AS cliffs_delta, {EFFECT} AS effect, {GROUP_SQL} AS "group" FROM test""")
def _(lake: Lake) -> DataFrame:
    return everything(stats.rank_test(stats.value_counts(lake.gold, GROUPED_FEATURES)).select("feature", "cliffs_delta", "effect", "group"))


SKEWS = " UNION ALL ".join(f"SELECT '{c}' AS feature, skewness(CAST({c} AS DOUBLE)) AS sk, CAST(min({c}) AS DOUBLE) AS low FROM gold" for c in GROUPED_FEATURES)


@query("i07_skewness_gate", f"WITH {GOLD}, s AS ({SKEWS}) SELECT feature, {r6('sk')} AS skew, {r6('low')} AS min_value, abs(sk) > 1.5 AND low >= 0 AS use_log1p FROM s")
def _(lake: Lake) -> DataFrame:
    return everything(stats.skewness_gate(lake.gold))


MEDIANS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, median(CAST({c} AS DOUBLE)) FILTER (WHERE click = 1) AS a, median(CAST({c} AS DOUBLE)) FILTER (WHERE click = 0) AS b FROM gold" for c in GROUPED_FEATURES
)


@query("i08_class_medians", f"WITH {GOLD}, m AS ({MEDIANS}) SELECT feature, {r6('a')} AS median_click, {r6('b')} AS median_no_click FROM m")
def _(lake: Lake) -> DataFrame:
    return everything(stats.class_medians(stats.value_counts(lake.gold, GROUPED_FEATURES)))


def _bins(c: str) -> str:
    return f"""SELECT '{c}' AS feature, click, CAST(LEAST(floor(({c} - lo) / CAST(hi - lo AS DOUBLE) * 30), 29) AS BIGINT) + 1 AS bin, count(*) AS n
       FROM gold CROSS JOIN (SELECT min({c}) AS lo, max({c}) AS hi FROM gold) GROUP BY 2, 3"""


@query("i09_class_histogram", f"""WITH {GOLD}, b AS ({' UNION ALL '.join(_bins(c) for c in GROUPED_FEATURES)})
       SELECT feature, click, bin, n, {r6('n / CAST(sum(n) OVER (PARTITION BY feature, click) AS DOUBLE)')} AS share FROM b""")
def _(lake: Lake) -> DataFrame:
    return everything(stats.class_histogram(lake.gold))


def _minmax(c: str) -> str:
    return f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"


@query("i10_combined_rank", f"""WITH {GOLD_VALUES},{RANK_TEST}, lv AS ({BINNED}), {MI}, {H}, c AS ({CORR_LONG}),
       m AS (SELECT feature, abs(r) AS abs_corr, mutual_info / entropy AS nmi, abs(cliffs_delta) AS abs_delta FROM c JOIN mi USING (feature) JOIN test USING (feature) CROSS JOIN h)
       SELECT feature, {r6('abs_corr')} AS abs_corr, {r6('nmi')} AS nmi, {r6('abs_delta')} AS abs_delta,
              {r6(f"({_minmax('abs_corr')} + {_minmax('nmi')} + {_minmax('abs_delta')}) / 3")} AS final_score FROM m""")
def _(lake: Lake) -> DataFrame:
    values = stats.value_counts(lake.gold, GROUPED_FEATURES)
    info = stats.normalized_information(stats.mutual_information(stats.quantile_level_counts(values)), lake.gold)
    measures = (
        stats.click_correlation(lake.gold).select("feature", F.abs("r").alias("abs_corr"))
        .join(info.select("feature", "nmi"), "feature")
        .join(stats.rank_test(values).select("feature", F.abs("cliffs_delta").alias("abs_delta")), "feature")
    )
    return everything(stats.combined_rank(measures, {"abs_corr": 1 / 3, "nmi": 1 / 3, "abs_delta": 1 / 3}))


def _tail(z: str) -> str:
    """Two-sided normal tail of z >= 0."""
    t = f"(1 / (1 + {z} / sqrt(2.0::DOUBLE) / 2))"
    poly = "0.0::DOUBLE"
    for c in reversed(ERFC_TERMS):
        poly = f"({poly} * {t} + ({c}))"
    return f"{t} * exp({poly} - {z} * {z} / 2)"


@query("i11_price_elasticity", f"""WITH RECURSIVE {STAR}, d AS MATERIALIZED (SELECT CAST(click AS DOUBLE) AS y, ln(1 + price) AS x FROM star WHERE price IS NOT NULL AND click IS NOT NULL),
       newton AS (SELECT 0 AS k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS v UNION ALL
         SELECT k + 1, a + (s2 * g0 - s1 * g1) / (s0 * s2 - s1 * s1), b + (s0 * g1 - s1 * g0) / (s0 * s2 - s1 * s1), s0 / (s0 * s2 - s1 * s1) FROM (
           SELECT k, a, b, sum(y - p) AS g0, sum((y - p) * x) AS g1, sum(p * (1 - p)) AS s0, sum(p * (1 - p) * x) AS s1, sum(p * (1 - p) * x * x) AS s2
           FROM (SELECT k, a, b, x, y, 1 / (1 + exp(-(a + b * x))) AS p FROM newton CROSS JOIN d WHERE k < 12) GROUP BY k, a, b)),
       f AS (SELECT b, a, sqrt(v) AS se, abs(b) / sqrt(v) AS z FROM newton WHERE k = 12)
       SELECT round(b, 5) + 0 AS coefficient, round(a, 5) + 0 AS intercept, round(se, 5) AS std_error, round({_tail('z')}, 5) AS p_value FROM f""")
def _(lake: Lake) -> DataFrame:
    row = stats.price_elasticity(lake.star.select("click", "price"))
    return row.select(*[(F.round(c, 5) + 0.0).alias(c) for c in row.columns])
