"""How strongly each feature relates to the click."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clickloom.constants import FEATURE_GROUPS, GROUPED_FEATURES
from clickloom.functions.scalar import effect_label, ratio
from clickloom.operators.prefix import by_value
from clickloom.operators.profile import equal_width_bin

# Chebyshev coefficients of the complementary error function, relative error below 1.2e-7.
ERFC_TERMS = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398,
    1.48851587, -0.82215223, 0.17087277,
]


def tidy(one_row: DataFrame, names: Sequence[str], out: str) -> DataFrame:
    """One row with a column per feature -> (feature, <out>)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias(out)) for c in names])
    return one_row.select(F.explode(pairs).alias("_p")).select("_p.*")


def feature_group(feature: Column) -> Column:
    group = F.lit(None).cast("string")
    for name, columns in FEATURE_GROUPS.items():
        group = F.when(feature.isin(*columns), F.lit(name)).otherwise(group)
    return group


def click_correlation(gold: DataFrame, features: Sequence[str] = GROUPED_FEATURES) -> DataFrame:
    """Pearson r of every feature with the click, one pass."""
    row = gold.agg(*[F.corr(F.col(c).cast("double"), F.col("click").cast("double")).alias(c) for c in features])
    return tidy(row, features, "r").withColumn("group", feature_group(F.col("feature")))


def ranked_correlation(gold: DataFrame) -> DataFrame:
    """Features of each group by decreasing |r|."""
    order = W.partitionBy("group").orderBy(F.desc(F.abs("r")), "feature")
    return click_correlation(gold).withColumn("position", F.row_number().over(order))


def correlation_pairs(gold: DataFrame, features: Sequence[str] = GROUPED_FEATURES, size: int | None = 15) -> DataFrame:
    """Feature pairs by decreasing |r|, each over the rows that have both values; pairs without an r are left out."""
    r = correlations(gold, features)
    pairs = [(a, b, float(r[i, j])) for i, a in enumerate(features) for j, b in enumerate(features) if i < j and not math.isnan(r[i, j])]
    out = gold.sparkSession.createDataFrame(pairs, "feature_a string, feature_b string, r double")
    out = out.orderBy(F.desc(F.abs("r")), "feature_a", "feature_b")
    return out.limit(size) if size else out


LOST = 1e-9     # of a sum of squares; a spread below is too small for a difference of sums


def correlations(rows: DataFrame, features: Sequence[str]) -> np.ndarray:
    """Pearson r of all pairs, NaN where there is none: one value, equal values, or one that is not finite.

    One pass finds a centre of each feature, a second sums all pairs at once as products of matrices.
    """
    value = {c: F.col(c).cast("double") for c in features}
    finite = {c: F.when(~F.isnan(v) & (F.abs(v) < math.inf), v) for c, v in value.items()}
    row = rows.agg(*[f(v) for v in finite.values() for f in (F.min, F.max, F.avg)]).first()
    centre = [low if low == high else mean for low, high, mean in zip(row[::3], row[1::3], row[2::3])]
    n, first, second, product, bad = pair_sums(rows.select(*[value[c].alias(c) for c in features]), [x or 0.0 for x in centre])
    with np.errstate(all="ignore"):
        spread, shared = second - first ** 2 / n, product - first * first.T / n
        r = shared / np.sqrt(spread * spread.T)
    r[(n < 2) | (bad > 0) | ~np.isfinite(r)] = np.nan
    close = (spread <= LOST * second) & (second > 0)
    for i, j in np.argwhere(np.triu((close | close.T) & (n > 1) & (bad == 0), 1)):
        a, b = value[features[i]], value[features[j]]
        both = rows.where(a.isNotNull() & b.isNotNull())
        low_a, high_a, low_b, high_b = both.agg(F.min(a), F.max(a), F.min(b), F.max(b)).first()
        r[i, j] = both.agg(F.corr(a, b)).first()[0] if low_a < high_a and low_b < high_b else np.nan
    return r


def pair_sums(rows: DataFrame, centre: Sequence[float]) -> np.ndarray:
    """(5, columns, columns) over the rows that have both the first and the second column: their number, the sum of the first one's
    distances from its centre, of their squares, of the products of both distances, and how many rows have one that is not finite."""
    k, middle = len(centre), np.asarray(centre)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((5, k, k))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            known = np.stack([np.asarray(c.is_valid()) for c in batch.columns]).astype(float)
            wild = known * ~np.isfinite(x)
            x = np.where((known > 0) & (wild == 0), x - middle, 0.0)
            uneven = wild @ known.T
            total += np.stack([known @ known.T, x @ known.T, x ** 2 @ known.T, x @ x.T, uneven + uneven.T])
        yield pa.record_batch([pa.array(range(5 * k), pa.int32()), pa.array(list(total.reshape(-1, k)), pa.list_(pa.float64()))], names=["line", "sums"])

    parts = rows.mapInArrow(run, "line int, sums array<double>")
    added = parts.groupBy("line").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    found = {r["line"]: r["sums"] for r in added.collect()}      # five rows per column
    return np.array([found.get(line, [0.0] * k) for line in range(5 * k)]).reshape(5, k, k)


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, level, n, clicks) of categorical columns."""
    levels = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in columns])
    rows = df.select(F.explode(levels).alias("_l"), "click").select("_l.*", "click")
    return rows.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("click").alias("clicks"))


def value_counts(gold: DataFrame, features: Sequence[str]) -> DataFrame:
    """Distinct values of numeric columns with their rows, clicks and everything below them."""
    return by_value(gold, features, {"n": F.lit(1), "clicks": F.col("click")})


def quantile_level_counts(values: DataFrame, bins: int = 64) -> DataFrame:
    """Numeric values as (feature, level, n, clicks) over equally full bins."""
    level = F.floor(F.col("n_below") * bins / F.col("n_total")).cast("string")
    return values.groupBy("feature", level.alias("level")).agg(F.sum("n").alias("n"), F.sum("clicks").alias("clicks"))


def mutual_information(levels: DataFrame) -> DataFrame:
    """Plug-in mutual information with the click, in nats, per feature."""
    totals = levels.groupBy("feature").agg(F.sum("n").alias("_n"), F.sum("clicks").alias("_c"))
    rows = levels.join(totals, "feature")

    def part(joint: Column, total: Column) -> Column:
        share = joint / F.col("_n")
        return F.when(joint > 0, share * F.ln(joint * F.col("_n") / (F.col("n") * total))).otherwise(0.0)

    hit, miss = F.col("clicks"), F.col("n") - F.col("clicks")
    info = part(hit.cast("double"), F.col("_c")) + part(miss.cast("double"), F.col("_n") - F.col("_c"))
    return rows.groupBy("feature").agg(F.sum(info).alias("mutual_info"))


def click_entropy(df: DataFrame) -> DataFrame:
    """Entropy of the click in nats."""
    p = F.avg("click")
    return df.agg(p.alias("p")).select("p", (-(F.col("p") * F.ln("p") + (1 - F.col("p")) * F.ln(1 - F.col("p")))).alias("entropy"))


def normalized_information(info: DataFrame, df: DataFrame) -> DataFrame:
    """Mutual information as a share of the click entropy."""
    return info.withColumn("nmi", F.col("mutual_info") / click_entropy(df).select("entropy").scalar())


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0."""
    t = 1 / (1 + x / 2)
    poly = F.lit(0.0)
    for c in reversed(ERFC_TERMS):
        poly = poly * t + F.lit(c)
    return t * F.exp(poly - x * x)


def rank_test(values: DataFrame) -> DataFrame:
    """Mann-Whitney U of clicked against other rows, two-sided p, Cliff's delta and its label.

    Works on collapsed values: rows of equal value share their average rank. The p-value is the
    normal approximation with tie and continuity correction.
    """
    pos, n = F.col("clicks").cast("double"), F.col("n").cast("double")
    neg_below = (F.col("n_below") - F.col("clicks_below")).cast("double")
    neg = n - pos
    sums = values.groupBy("feature").agg(
        F.sum(pos * (neg_below + neg / 2)).alias("u"),
        F.sum(n * n * n - n).alias("_ties"),
        F.max("clicks_total").cast("double").alias("_a"), F.max("n_total").cast("double").alias("_n"),
    )
    a, total = F.col("_a"), F.col("_n")
    b = total - a
    spread = F.sqrt(a * b / 12 * ((total + 1) - F.col("_ties") / F.nullif(total * (total - 1), F.lit(0.0))))
    z = F.greatest(F.abs(F.col("u") - a * b / 2) - 0.5, F.lit(0.0)) / F.nullif(spread, F.lit(0.0))
    out = sums.select(
        "feature", "u", F.least(erfc(z / math.sqrt(2.0)), F.lit(1.0)).alias("p_value"),
        (2 * ratio(F.col("u"), a * b) - 1).alias("cliffs_delta"),
    )
    return out.withColumns({"effect": effect_label(F.col("cliffs_delta")), "group": feature_group(F.col("feature"))})


def skewness_gate(gold: DataFrame, features: Sequence[str] = GROUPED_FEATURES, limit: float = 1.5) -> DataFrame:
    """Sample skewness and whether a log1p transform is due: |skew| above the limit, no negatives."""
    per = gold.agg(*[
        F.struct(F.skewness(F.col(c).cast("double")).alias("g"), F.count(c).cast("double").alias("n"), F.min(F.col(c).cast("double")).alias("low")).alias(c)
        for c in features
    ])
    n = F.col("s.n")
    sample = F.col("s.g") * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return tidy(per, features, "s").select(
        "feature", sample.alias("skew"), F.col("s.low").alias("min_value"),
        ((F.abs(sample) > limit) & (F.col("s.low") >= 0)).alias("use_log1p"),
    )


def class_medians(values: DataFrame) -> DataFrame:
    """Median of each feature among clicked and other rows, read off the collapsed values."""
    def median(here: Column, below: Column, total: Column) -> Column:
        low, high = F.floor((total - 1) / 2), F.floor(total / 2)
        at = lambda k: F.max(F.when((below <= k) & (k < below + here), F.col("value")))
        return (at(low) + at(high)) / 2

    hit = median(F.col("clicks"), F.col("clicks_below"), F.col("clicks_total"))
    miss = median(F.col("n") - F.col("clicks"), F.col("n_below") - F.col("clicks_below"), F.col("n_total") - F.col("clicks_total"))
    return values.groupBy("feature").agg(hit.alias("median_click"), miss.alias("median_no_click"))


def class_histogram(gold: DataFrame, features: Sequence[str] = GROUPED_FEATURES, bins: int = 30) -> DataFrame:
    """Equal-width histogram of each feature per class, as density over the class."""
    spans = gold.agg(*[
        F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi")).alias(c) for c in features
    ])
    limits = spans.select(F.struct(*features)).scalar()
    rows = gold.withColumn("_s", limits)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), equal_width_bin(F.col(c), F.col(f"_s.{c}.lo"), F.col(f"_s.{c}.hi"), bins).alias("bin"))
        for c in features
    ])
    counts = rows.select(F.explode(pairs).alias("_p"), "click").select("_p.*", "click").groupBy("feature", "click", "bin").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("feature", "click")))


def combined_rank(measures: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Min-max each measure over the features and add them up by weight."""
    everything = W.partitionBy()
    score = F.lit(0.0)
    for c, w in weights.items():
        low, high = F.min(c).over(everything), F.max(c).over(everything)
        score = score + ratio(F.col(c) - low, high - low) * F.lit(w)
    return measures.withColumn("final_score", score)


def price_elasticity(star: DataFrame) -> DataFrame:
    """Logistic fit of the click on log1p(price): coefficient, standard error and p-value."""
    rows = star.select(F.col("click").cast("double").alias("label"), F.log1p("price").alias("x")).na.drop()
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    model = GeneralizedLinearRegression(family="binomial", link="logit", maxIter=50, tol=1e-10).fit(data)
    s = model.summary
    row = (float(model.coefficients[0]), float(model.intercept), float(s.coefficientStandardErrors[0]), float(s.pValues[0]))
    return star.sparkSession.createDataFrame([row], "coefficient double, intercept double, std_error double, p_value double")
