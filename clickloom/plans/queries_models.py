"""Model preparation, training and comparison (J13-J21)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window as W, functions as F

from clickloom.constants import CATEGORICAL_FEATURES, NUMERIC_FEATURES, RECALL_KS
from clickloom.functions.scalar import six
from clickloom.operators import blockscore, models, ranking, trees
from clickloom.operators.candidates import click_queries
from clickloom.operators.dictionaries import dictionary
from clickloom.operators.encode import is_train
from clickloom.plans import training
from clickloom.plans.lake import Lake
from clickloom.plans.oracle import GOLD, QUERIES, big, r6, ranks, values_of
from clickloom.plans.queries_profile import everything
from clickloom.plans.queries_ranking import RANDOM
from clickloom.plans.registry import query
from clickloom.session import materialize


RECALLS = ", ".join(f"{r6(f'avg(CAST(rank < {k} AS INT))')} AS recall_at_{k}" for k in RECALL_KS)


def split(lake: Lake) -> tuple[DataFrame, DataFrame]:
    return lake.gold.where(is_train()), lake.gold.where(~is_train())


def quality(model: PipelineModel, test: DataFrame, name: str) -> DataFrame:
    rows = materialize(models.scored(model, test, "click"), "scores")     # read by three measures
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.avg("score").alias("mean_score")).select(
        F.lit(name).alias("model"), "rows", "mean_score", ranking.auc(rows, "score").scalar().alias("auc"),
        ranking.log_loss(rows, "score").scalar().alias("log_loss"),
    )


@query("j13_standardized", f"""WITH {GOLD}, t AS (SELECT * FROM gold WHERE _split = 'train'), s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS d_{c}' for c in NUMERIC_FEATURES)} FROM t)
       SELECT event_id, {', '.join(r6(f'({c} - m_{c}) / d_{c}') + f' AS {c}' for c in NUMERIC_FEATURES)} FROM gold CROSS JOIN s""")
def _(lake: Lake) -> DataFrame:
    train, _ = split(lake)
    stages = [VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="_v"), StandardScaler(inputCol="_v", outputCol="_s", withMean=True, withStd=True)]
    rows = Pipeline(stages=stages).fit(train).transform(lake.gold).withColumn("_a", vector_to_array("_s"))
    return rows.select("event_id", *[six(F.col("_a")[i]).alias(c) for i, c in enumerate(NUMERIC_FEATURES)])


ORDERED = ", ".join(f"o_{c} AS (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS slot FROM gold WHERE _split = 'train' GROUP BY 1)" for c in CATEGORICAL_FEATURES)


@query("j14_one_hot", f"""WITH {GOLD}, {ORDERED} SELECT event_id, {', '.join(f'COALESCE(o_{c}.slot, -1) AS {c}' for c in CATEGORICAL_FEATURES)}
       FROM gold {' '.join(f'LEFT JOIN o_{c} USING ({c})' for c in CATEGORICAL_FEATURES)}""")
def _(lake: Lake) -> DataFrame:
    table = dictionary(lake.train, CATEGORICAL_FEATURES)
    rows = trees.with_category(lake.gold.select("event_id", *CATEGORICAL_FEATURES), table, "slot", CATEGORICAL_FEATURES, "_slot", F.lit(-1).cast("bigint"))
    return rows.select("event_id", *[F.col(f"{c}_slot").alias(c) for c in CATEGORICAL_FEATURES])


@query("j15_logistic_regression")
def _(lake: Lake) -> DataFrame:
    _, test = split(lake)
    return quality(lake.model("logistic"), test, "logistic")


@query("j15_score_equations", f"""WITH {GOLD} SELECT feature, 0.0::DOUBLE AS slope, (SELECT count(*) FROM gold WHERE _split = 'train') AS rows
       FROM (SELECT unnest([{', '.join(repr(c) for c in NUMERIC_FEATURES)}, 'intercept']) AS feature)""")
def _(lake: Lake) -> DataFrame:
    """Slopes of the penalised loss at the fitted coefficients; all vanish where the fit is the optimum."""
    coded, pull = blockscore.Coded({"logistic": lake.model("logistic")}), lake.model("logistic").stages[-1].getRegParam()
    numbers, _, _ = coded.parts["logistic"]
    rows = blockscore.scored_rows(coded, lake.train, "click", *NUMERIC_FEATURES).withColumn("_e", F.get("scores", 0) - F.col("click"))
    scaled = lambda c, mean, spread: F.coalesce((F.col(c) - mean) / spread, F.lit(0.0)) if spread else F.lit(0.0)
    slopes = [F.avg(F.col("_e") * scaled(c, mean, spread)) + F.lit(pull * w) for c, (mean, spread, w) in numbers.items()] + [F.avg("_e")]
    named = F.array(*[F.struct(F.lit(f).alias("feature"), (F.round(v, 3) + 0.0).alias("slope")) for f, v in zip([*NUMERIC_FEATURES, "intercept"], slopes)])
    return rows.agg(named.alias("_p"), F.count(F.lit(1)).alias("rows")).select(F.explode("_p").alias("_p"), "rows").select("_p.*", "rows")


@query("j15_category_equations", f"""WITH {GOLD} SELECT * FROM ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS rows, 0.0::DOUBLE AS slope FROM gold WHERE _split = 'train' GROUP BY {c}" for c in CATEGORICAL_FEATURES)})""")
def _(lake: Lake) -> DataFrame:
    """The same slopes for the weight of every category: errors of its rows against the pull of the penalty."""
    coded = blockscore.Coded({"logistic": lake.model("logistic")})
    _, weights, _ = coded.parts["logistic"]
    scored = blockscore.scored_rows(coded, lake.train, "click", *CATEGORICAL_FEATURES).withColumn("score", F.get("scores", 0))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in CATEGORICAL_FEATURES])).alias("_p")
    errors = scored.select(pairs, (F.col("score") - F.col("click")).alias("_e")).select("_p.*", "_e").groupBy("column", "value").agg(F.sum("_e").alias("_e"), F.count("*").alias("rows"))
    slope = (F.col("_e") + F.col("weight")) / F.sum("rows").over(W.partitionBy("column"))
    found = errors.join(weights, ["column", "value"], "left")
    return found.select(F.col("column").alias("column_name"), "value", "rows", (F.round(slope, 4) + 0.0).alias("slope"))


@query("j16_random_forest")
def _(lake: Lake) -> DataFrame:
    _, test = split(lake)
    return quality(lake.model("forest"), test, "forest")


@query("j17_boosted_trees")
def _(lake: Lake) -> DataFrame:
    _, test = split(lake)
    names = [n for n in training.FITS if n.startswith("boosted")]
    rows = [quality(model, test, n) for n, model in lake.models(names).items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


STUMP_RATES = " UNION ALL ".join(
    f"SELECT {i} AS i, '{c}' AS feature, {c} AS v, count(*) AS n, sum(click) AS c, (sum(click) + max(gm) * 20.0::DOUBLE) / (count(*) + 20.0::DOUBLE) AS rate FROM t CROSS JOIN p GROUP BY {c}"
    for i, c in enumerate(CATEGORICAL_FEATURES))


@query("j17_first_split", f"""WITH {GOLD}, t AS (SELECT * FROM gold WHERE _split = 'train'), p AS (SELECT avg(click) AS gm, CAST(count(*) AS DOUBLE) AS n, CAST(sum(click) AS DOUBLE) AS c FROM t),
       r AS ({STUMP_RATES}), g AS (SELECT i, feature, rate, sum(n) AS n, sum(c) AS c FROM r GROUP BY 1, 2, 3),
       s AS (SELECT g.*, sum(g.n) OVER w AS ln, sum(g.c) OVER w AS lc, p.n AS tn, p.c AS tc, gm FROM g CROSS JOIN p WINDOW w AS (PARTITION BY feature ORDER BY rate)),
       e AS (SELECT *, ln * gm - lc AS lg, ln * gm * (1 - gm) AS lh, (tn - ln) * gm - (tc - lc) AS rg, (tn - ln) * gm * (1 - gm) AS rh FROM s WHERE ln < tn),
       b AS (SELECT *, lg * lg / lh + rg * rg / rh AS gain FROM e ORDER BY round(lg * lg / lh + rg * rg / rh, 6) DESC, i, rate LIMIT 1)
       SELECT feature, {r6('rate')} AS cut, {big('ln')} AS rows_left, {big('tn - ln')} AS rows_right, {big('lc')} AS clicks_left, {big('tc - lc')} AS clicks_right,
              round(-0.1::DOUBLE * lg / lh, 4) + 0.0 AS value_left, round(-0.1::DOUBLE * rg / rh, 4) + 0.0 AS value_right FROM b""")
def _(lake: Lake) -> DataFrame:
    """One round with one split over the categories: what the histograms must find."""
    known = trees.Prepared.of(lake.train, numeric=[])
    model = trees.fit(known, trees.Growth(rounds=1, step=0.1, leaves=2, depth=1))
    tree = trees.Tree.of(model.trees[0])
    feature, at = CATEGORICAL_FEATURES[tree.feature[0]], int(tree.cut[0])
    cut = known.cuts[tree.feature[0]][at - 1]
    side = trees.with_category(lake.train, known.categories, "rate", [feature], trees.RATE, known.clicks).select("click", (F.col(feature + trees.RATE) <= cut).alias("left"))
    value = lambda k: six(F.round(F.lit(float(tree.value[tree.left[0] + k])), 4)) + 0.0
    return side.agg(
        F.lit(feature).alias("feature"), six(F.lit(cut)).alias("cut"), F.count_if("left").alias("rows_left"), F.count_if(~F.col("left")).alias("rows_right"),
        F.sum(F.when(F.col("left"), F.col("click")).otherwise(0)).alias("clicks_left"), F.sum(F.when(~F.col("left"), F.col("click")).otherwise(0)).alias("clicks_right"),
        value(0).alias("value_left"), value(1).alias("value_right"),
    )


@query("j19_floors", f"""WITH {QUERIES},{ranks('ag_ctr_before')}, {ranks(RANDOM).replace('ranked', 'ranked2').replace('ranks AS', 'ranks2 AS').strip()},
       {values_of(['ag_ctr_before'], "gold WHERE _split = 'test'")}
       SELECT 'popularity' AS model, (SELECT {r6('sum(CAST(pos AS DOUBLE) * ((n_below - pos_below) + (n - pos) / 2.0::DOUBLE)) / (max(pos_total) * (max(n_total) - max(pos_total)))')} FROM vals) AS auc, {RECALLS} FROM ranks
       UNION ALL SELECT 'random', 0.5, {RECALLS} FROM ranks2""")
def _(lake: Lake) -> DataFrame:
    """The two rows of the comparison that no model stands behind."""
    found = training.floors(lake.gold.where(~is_train()), lake.lookups, click_queries(lake.gold))
    return everything(found[0].unionByName(found[1]))


@query("j19_model_comparison")
def _(lake: Lake) -> DataFrame:
    return training.compared(lake.models(), lake.gold, lake.lookups)


@query("j20_feature_importance")
def _(lake: Lake) -> DataFrame:
    train, _ = split(lake)
    return models.importance(lake.model("forest"), train)


@query("j21_permutation_importance")
def _(lake: Lake) -> DataFrame:
    _, test = split(lake)
    return models.permutation_importance(lake.model("logistic"), test)


@query("j24_model_recommendations")
def _(lake: Lake) -> DataFrame:
    _, test = split(lake)
    users = test.select(F.col("userid_key").alias("userid")).distinct()
    recs = training.recommend(lake.model("logistic"), lake.gold, lake.lookups, users)
    return recs.select("userid", F.to_json("recommendations").alias("recommendations"))
