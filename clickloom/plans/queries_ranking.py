"""Snapshots, candidates, ranking metrics and recommendations (J) under a fixed score."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.constants import AD_DYNAMIC, CATEGORY_DYNAMIC, LIFT_PERCENTS, RECALL_KS
from clickloom.functions.scalar import six
from clickloom.operators import ranking
from clickloom.operators.candidates import (
    catalog_of, click_queries, every_block, first_seen_catalog, frozen_affinity, frozen_prices, linear_score, popularity_score,
    product_snapshot, user_snapshot, with_candidates,
)
from clickloom.operators.encode import is_train
from clickloom.operators.models import with_validation_flag
from clickloom.plans.lake import Lake
from clickloom.plans.oracle import CATALOG, GOLD, IMP, QUERIES, STAR, big, r6, ranks, values_of
from clickloom.plans.queries_history import tidy
from clickloom.plans.queries_landing import RECS, _scored_users
from clickloom.plans.queries_profile import everything
from clickloom.plans.registry import query


def state_sql(columns: list[str]) -> str:
    return ", ".join(f"{big(c)} AS {c}" if "clicks" in c or "impressions" in c else f"{r6(c)} AS {c}" for c in columns)


def query_ranks(lake: Lake, score=linear_score) -> DataFrame:
    return ranking.true_ranks(click_queries(lake.gold), lake.lookups, score)


@query("j01_product_snapshot", f"WITH {CATALOG} SELECT adgroup_id_key AS adgroup_id, cate_id, brand, {r6('price')} AS price, {state_sql(AD_DYNAMIC)} FROM products")
def _(lake: Lake) -> DataFrame:
    return everything(product_snapshot(lake.gold))


@query("j02_catalog", f"WITH {CATALOG} SELECT adgroup_id, cate_id, brand, {r6('price')} AS price, {state_sql(AD_DYNAMIC + CATEGORY_DYNAMIC)} FROM catalog")
def _(lake: Lake) -> DataFrame:
    return everything(catalog_of(lake.gold))


@query("j03_first_seen_catalog", f"""WITH {STAR} SELECT adgroup_id, cate_id, price FROM (
       SELECT *, row_number() OVER (PARTITION BY adgroup_id ORDER BY us, event_id) AS rn FROM star) WHERE rn = 1""")
def _(lake: Lake) -> DataFrame:
    return first_seen_catalog(lake.star)


@query("j04_frozen_affinity", f"""WITH {CATALOG} SELECT 'category' AS kind, userid_key AS userid, cate_id AS key, {r6('v')} AS v FROM uc UNION ALL
       SELECT 'brand', userid_key, brand, {r6('v')} FROM ub UNION ALL SELECT 'price', userid_key, '', {r6('v')} FROM up""")
def _(lake: Lake) -> DataFrame:
    part = lambda df, kind, key: df.select(F.lit(kind).alias("kind"), "userid", key.alias("key"), six(F.col("v")).alias("v"))
    prior = lake.prior
    return (
        part(frozen_affinity(lake.gold, "cate_id", "v", prior), "category", F.col("cate_id"))
        .unionByName(part(frozen_affinity(lake.gold, "brand", "v", prior), "brand", F.col("brand")))
        .unionByName(part(frozen_prices(lake.gold).withColumnRenamed("user_avg_clicked_price", "v"), "price", F.lit("")))
    )


CROSS = {
    "pid_x_cate_id_freq": "f_pid_cate", "cate_id_x_age_level_freq": "f_cate_age", "brand_x_cms_group_id_freq": "f_brand_cms",
    "item_coclick_affinity": "coclick", "user_cate_affinity_before": "user_cate", "user_brand_affinity_before": "user_brand",
    "user_price_gap": "price_gap",
}


@query("j05_candidates", f"WITH {QUERIES} SELECT query_id, count(*) AS n, " + ", ".join(
    f"{r6(f'sum({c})')} AS {n}_sum, {r6(f'max({c})')} AS {n}_max" for n, c in CROSS.items()) + " FROM cand GROUP BY 1")
def _(lake: Lake) -> DataFrame:
    rows = with_candidates(click_queries(lake.gold), lake.lookups)

    def both(name: str) -> list:
        total = F.sum(F.aggregate("candidates", F.lit(0.0), lambda a, c: a + c[name]))
        top = F.max(F.array_max(F.transform("candidates", lambda c: c[name])))
        return [six(total).alias(f"{name}_sum"), six(top).alias(f"{name}_max")]

    return rows.groupBy("query_id").agg(F.sum(F.size("candidates")).alias("n"), *[c for n in CROSS for c in both(n)])


def recall_sql(score: str) -> str:
    ks = ", ".join(f"{r6(f'avg(CAST(rank < {k} AS INT))')} AS recall_at_{k}" for k in RECALL_KS)
    return f"WITH {QUERIES},{ranks(score)} SELECT count(*) AS queries, {ks} FROM ranks"


@query("j06_recall", recall_sql("score"))
def _(lake: Lake) -> DataFrame:
    return everything(ranking.recall_at(query_ranks(lake)))


@query("j07_precision", f"""WITH {QUERIES},{ranks('score')}, ks AS (SELECT unnest([10, 50, 100]) AS k),
       s AS (SELECT CAST(k AS BIGINT) AS k, count(*) FILTER (WHERE rank < k) AS hits, CAST(count(*) AS DOUBLE) AS n, CAST(max(catalog_size) AS DOUBLE) AS size FROM ranks CROSS JOIN ks GROUP BY 1)
       SELECT k, {r6('hits / (n * k)')} AS precision, {r6('hits / n')} AS recall, {r6('1 / size')} AS random_precision, {r6('k / size')} AS random_recall,
              {r6('hits / (n * k) * size')} AS precision_lift FROM s""")
def _(lake: Lake) -> DataFrame:
    return everything(ranking.precision_at(query_ranks(lake)))


RANDOM = "CAST('0x' || substr(md5('42:' || CAST(query_id AS VARCHAR) || ':' || CAST(adgroup_id AS VARCHAR)), 1, 8) AS BIGINT)"


@query("j08_random_baseline", recall_sql(RANDOM))
def _(lake: Lake) -> DataFrame:
    return everything(ranking.recall_at(query_ranks(lake, ranking.random_score())))


@query("j09_popularity_baseline", recall_sql("ag_ctr_before"))
def _(lake: Lake) -> DataFrame:
    return everything(ranking.recall_at(query_ranks(lake, popularity_score)))


TESTS = f"{GOLD}, test AS (SELECT * FROM gold WHERE _split = 'test')"


@query("j10_auc", f"""WITH {TESTS},{values_of(['ag_ctr_before', 'adgroup_id_te', 'user_ctr_before'], 'test')}
       SELECT feature, {r6('sum(CAST(pos AS DOUBLE) * ((n_below - pos_below) + (n - pos) / 2.0::DOUBLE)) / (max(pos_total) * (max(n_total) - max(pos_total)))')} AS auc FROM vals GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    return everything(ranking.auc_of(lake.gold.where(~is_train()), ["ag_ctr_before", "adgroup_id_te", "user_ctr_before"]))


@query("j11_log_loss", f"""WITH {TESTS} SELECT {r6("avg(-ln(CASE WHEN click = 1 THEN p ELSE 1 - p END))")} AS log_loss
       FROM (SELECT click, greatest(1e-15, least(1 - 1e-15, adgroup_id_te)) AS p FROM test)""")
def _(lake: Lake) -> DataFrame:
    return everything(ranking.log_loss(lake.gold.where(~is_train()), "adgroup_id_te"))


LIFT_ROWS = " UNION ALL ".join(f"SELECT {p} AS p" for p in LIFT_PERCENTS)


@query("j12_lift", f"""WITH {TESTS}, o AS (SELECT click, row_number() OVER (ORDER BY ag_ctr_before DESC, event_id) AS i, count(*) OVER () AS n, avg(click) OVER () AS overall FROM test),
       ps AS ({LIFT_ROWS}), k AS (SELECT p, greatest(1, CAST(floor(n * p / 100.0) AS BIGINT)) AS k, i, click, overall FROM o CROSS JOIN ps)
       SELECT CAST(p AS BIGINT) AS top_percent, max(k) AS n_impressions, {r6('sum(CASE WHEN i <= k THEN click END) / CAST(max(k) AS DOUBLE)')} AS ctr,
              {r6('sum(CASE WHEN i <= k THEN click END) / CAST(max(k) AS DOUBLE) / max(overall)')} AS lift FROM k GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    return everything(ranking.lift_table(lake.gold.where(~is_train()), "ag_ctr_before"))


@query("j18_validation_cut", f"""WITH {GOLD}, t AS (SELECT *, row_number() OVER (ORDER BY us, event_id) - 1 AS pos, count(*) OVER () AS n FROM gold WHERE _split = 'train')
       SELECT pos >= floor(n * 0.85::DOUBLE) AS is_validation, count(*) AS n, min(us) AS first_us, max(us) AS last_us, {big('sum(click)')} AS clicks FROM t GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    train = with_validation_flag(lake.gold.where(is_train())).withColumn("_us", F.unix_micros("time_stamp"))
    return train.groupBy("is_validation").agg(
        F.count(F.lit(1)).alias("n"), F.min("_us").alias("first_us"), F.max("_us").alias("last_us"), F.sum("click").alias("clicks")
    )


@query("j22_user_sample", f"WITH {IMP}, u AS (SELECT DISTINCT userid FROM imp WHERE _split = 'test') SELECT userid FROM u ORDER BY md5('42:' || CAST(userid AS VARCHAR)), userid LIMIT 100")
def _(lake: Lake) -> DataFrame:
    return ranking.sampled_users(lake.imp.where(~is_train()))


@query("j23_user_snapshot", f"""WITH {GOLD}, u AS (SELECT DISTINCT userid_key FROM gold WHERE _split = 'test'),
       l AS (SELECT *, row_number() OVER (PARTITION BY userid_key ORDER BY us DESC, event_id DESC) AS rn FROM gold WHERE userid_key IN (SELECT userid_key FROM u))
       SELECT userid_key AS userid, pid, hour, {r6('userid_te')} AS userid_te, {big('user_clicks_before')} AS user_clicks_before, user_impressions_before,
              {r6('user_ctr_before')} AS user_ctr_before, COALESCE(user_prev_clicked_item, -1) AS user_prev_clicked_item FROM l WHERE rn = 1""")
def _(lake: Lake) -> DataFrame:
    users = lake.gold.where(~is_train()).select(F.col("userid_key").alias("userid")).distinct()
    out = user_snapshot(lake.gold, users, train_only=False).fillna(-1, ["user_prev_clicked_item"])
    return tidy(out, "userid", "pid", "hour", "userid_te", "user_clicks_before", "user_impressions_before", "user_ctr_before", "user_prev_clicked_item")


@query("j24_top_recommendations", f"WITH {RECS} SELECT * FROM best WHERE position < 100")
def _(lake: Lake) -> DataFrame:
    rows = ranking.exploded_recommendations(ranking.recommendations(_scored_users(lake), size=100))
    return rows.withColumn("score", F.col("score") + 0.0)


@query("j06_recall_in_blocks", recall_sql("score"))
def _(lake: Lake) -> DataFrame:
    """Many small blocks, most of which their range of scores decides."""
    return everything(ranking.recall_at(ranking.true_ranks(click_queries(lake.gold), lake.small_blocks, linear_score)))


@query("j24_top_in_blocks", f"WITH {RECS} SELECT * FROM best WHERE position < 10")
def _(lake: Lake) -> DataFrame:
    users = user_snapshot(lake.gold, lake.gold.where(~is_train()).select(F.col("userid_key").alias("userid")).distinct())
    recs = ranking.recommendations(ranking.best_scored(users, lake.small_blocks, linear_score, size=10), size=10)
    return ranking.exploded_recommendations(recs).withColumn("score", F.col("score") + 0.0)


@query("j25_recalibration", f"WITH {GOLD} SELECT event_id, {r6('userid_te / (userid_te + (1 - userid_te) * ((0.2 / 0.8) / (0.05 / 0.95))::DOUBLE)')} AS p FROM gold")
def _(lake: Lake) -> DataFrame:
    return lake.gold.select("event_id", six(ranking.recalibrated(F.col("userid_te"), 0.2, 0.05)).alias("p"))


@query("j26_frequency_cap", f"""WITH {IMP}, stats AS (SELECT userid, count(*) AS impressions, sum(click) AS clicks FROM imp GROUP BY 1),
       o AS (SELECT userid, row_number() OVER (ORDER BY impressions DESC, userid) - 1 AS i, count(*) OVER () AS n FROM stats),
       heavy AS (SELECT userid FROM o WHERE i < floor(n * 0.05::DOUBLE)),
       served AS (SELECT userid, adgroup_id, count(*) AS score FROM imp GROUP BY 1, 2),
       r AS (SELECT *, row_number() OVER (PARTITION BY userid ORDER BY score DESC, adgroup_id) AS rn FROM served)
       SELECT userid, adgroup_id, score FROM r WHERE userid NOT IN (SELECT userid FROM heavy) OR rn <= 10""")
def _(lake: Lake) -> DataFrame:
    served = lake.imp.groupBy("userid", "adgroup_id").agg(F.count(F.lit(1)).alias("score"))
    return ranking.frequency_capped(lake.imp, served, 10).select("userid", "adgroup_id", "score")


@query("j27_price_tie_break", f"""WITH {CATALOG}, p AS (SELECT adgroup_id, price, floor(ag_ctr_before * 20) AS score FROM catalog),
       u AS (SELECT DISTINCT userid_key AS userid FROM gold WHERE _split = 'test')
       SELECT userid, row_number() OVER (PARTITION BY userid ORDER BY score DESC, price, adgroup_id) - 1 AS position, adgroup_id, {r6('score')} AS score FROM u CROSS JOIN p
       QUALIFY position < 20""")
def _(lake: Lake) -> DataFrame:
    users = lake.gold.where(~is_train()).select(F.col("userid_key").alias("userid")).distinct()
    coarse = lambda ad: F.floor(ad["ag_ctr_before"] * 20).cast("double")
    pairs = F.transform("ads", lambda ad: F.struct(coarse(ad).alias("score"), ad["adgroup_id"].alias("adgroup_id"), ad["price"].alias("price")))
    scored = every_block(users, lake.lookups.blocks).select("userid", pairs.alias("scored"))
    recs = ranking.recommendations(scored, size=20, cheapest_first=True)
    return ranking.exploded_recommendations(recs).withColumn("score", F.col("score") + 0.0)
