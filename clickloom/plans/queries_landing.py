"""Sources, layout, cleaning and joins (A, B, C)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.constants import AD_COLUMNS, FACT_KEY
from clickloom.functions.scalar import category_text, ratio, six
from clickloom.operators import clean, coclick, profile
from clickloom.operators.asof import as_of_join
from clickloom.operators.candidates import (
    click_queries, numbered_queries, product_snapshot, category_snapshot, with_candidates, linear_score,
)
from clickloom.operators.encode import encode_ids, is_train
from clickloom.operators.joins import lookup
from clickloom.operators.prefix import row_position
from clickloom.operators.ranking import best_scored, exploded_recommendations, recommendations, true_ranks, write_recommendations
from clickloom.operators.candidates import user_snapshot
from clickloom.plans.lake import Lake
from clickloom.plans.oracle import ADS, CATALOG, DIRTY, ENCODED, GOLD, IMP, QUERIES, STAR, USERS, big, candidates, r6, ranks
from clickloom.plans.registry import query
from clickloom.session import materialize, new_path
from clickloom.sources import bindings
from clickloom.sources.raw import read_days, tagged, write_days

N = lambda: F.count(F.lit(1))


@query("a04_lineage", f"""WITH {IMP} SELECT _split, 'events.parquet' AS source_file, count(*) AS n,
       CAST(1 AS BIGINT) AS run_instants FROM imp GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    events = tagged(lake.table("events"), None, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    split = F.when(F.col("ts").cast("timestamp") < F.lit(bindings.SPLIT_AT).cast("timestamp"), "train").otherwise("test")
    return events.withColumn("_split", split).groupBy("_split", F.col("_source_file").alias("source_file")).agg(
        N().alias("n"), F.countDistinct("_ingested_at").alias("run_instants")
    )


def _halves(lake: Lake) -> tuple[DataFrame, DataFrame]:
    rows = lake.imp.select("event_id", "userid", "adgroup_id", "click", "pid", "_split")
    return rows.where(is_train()), rows.where(~is_train()).drop("pid")


@query("a05_split_union", f"""WITH {IMP} SELECT event_id, userid, adgroup_id, click,
       CASE WHEN _split = 'train' THEN pid END AS pid, _split FROM imp""")
def _(lake: Lake) -> DataFrame:
    train, test = _halves(lake)
    return train.unionByName(test, allowMissingColumns=True).withColumn("click", F.col("click").cast("bigint"))


DAYS_SQL = f"WITH {IMP} SELECT date AS dt, count(*) AS n, {big('sum(click)')} AS clicks FROM imp GROUP BY 1"


@query("a06_day_sink", DAYS_SQL)
def _(lake: Lake) -> DataFrame:
    path = new_path(lake.spark, "days")
    write_days(lake.imp.withColumn("date", F.col("date").cast("string")), path)
    days = read_days(lake.spark, path)
    return days.groupBy(F.col("dt").cast("string").alias("dt")).agg(N().alias("n"), F.sum("click").alias("clicks"))


@query("a08_pruned_scan", f"""WITH {IMP} SELECT date AS dt, count(*) AS n, {big('sum(click)')} AS clicks
       FROM imp WHERE date >= '2024-01-10' AND date < '2024-01-20' GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    path = new_path(lake.spark, "days")
    write_days(lake.imp.withColumn("date", F.col("date").cast("string")), path)
    days = read_days(lake.spark, path).where((F.col("dt") >= F.lit("2024-01-10").cast("date")) & (F.col("dt") < F.lit("2024-01-20").cast("date")))
    return days.groupBy(F.col("dt").cast("string").alias("dt")).agg(N().alias("n"), F.sum("click").alias("clicks"))


STAR_COLUMNS = [
    "event_id", "userid", "adgroup_id", "click", "pid", "hour", "weekday", "_split", "cate_id", "campaign_id", "customer",
    "brand", "price", "cms_segid", "cms_group_id", "final_gender_code", "age_level", "pvalue_level", "shopping_level",
    "occupation", "new_user_class_level",
]
WHOLE = ["click", "hour", "weekday"]


def _wide(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in WHOLE if c in df.columns})


@query("a09_star_join", f"WITH {STAR} SELECT {', '.join(STAR_COLUMNS)}, us, date FROM star")
def _(lake: Lake) -> DataFrame:
    return _wide(lake.star.select(*STAR_COLUMNS, F.col("_us").alias("us"), F.col("date").cast("string").alias("date")))


@query("a10_coclick_sink", f"WITH {CATALOG} SELECT prev_item, item, {big('cnt')} AS cnt, {big('total')} AS total FROM snap")
def _(lake: Lake) -> DataFrame:
    return materialize(coclick.coclick_snapshot(lake.gold, "adgroup_id_key"), "coclick")


def _scored_users(lake: Lake) -> DataFrame:
    sample = lake.gold.where(~is_train()).select(F.col("userid_key").alias("userid")).distinct()
    return best_scored(user_snapshot(lake.gold, sample), lake.lookups, linear_score)


RECS = f"""{CATALOG},
ux AS (
  SELECT userid_key AS userid, pid, age_level, cms_group_id, user_prev_clicked_item FROM (
    SELECT *, row_number() OVER (PARTITION BY userid_key ORDER BY us DESC, event_id DESC) AS rn FROM train
    WHERE userid_key IN (SELECT userid_key FROM gold WHERE _split = 'test')) WHERE rn = 1),{candidates("ux")},
best AS (
  SELECT userid, row_number() OVER (PARTITION BY userid ORDER BY score DESC, adgroup_id) - 1 AS position, adgroup_id,
         {r6("score")} AS score FROM scored)"""


@query("a11_recommendation_rows", f"WITH {RECS} SELECT * FROM best WHERE position < 100")
def _(lake: Lake) -> DataFrame:
    """The top 100 of every test user, written as JSON and read back."""
    recs = recommendations(_scored_users(lake))
    path = new_path(lake.spark, "recommendations")
    write_recommendations(recs, path)
    rows = exploded_recommendations(lake.spark.read.schema(recs.schema).json(path))
    return rows.withColumn("score", F.col("score") + 0.0)


@query("b01_projection", f"WITH {ADS} SELECT {', '.join(AD_COLUMNS)} FROM ads")
def _(lake: Lake) -> DataFrame:
    return lake.ads.select(*AD_COLUMNS)


@query("b02_fact_dedup", f"""WITH {DIRTY} SELECT event_id, userid, adgroup_id, us, click, copy_no FROM (
       SELECT *, row_number() OVER (PARTITION BY userid, adgroup_id, us ORDER BY copy_no, event_id) AS rn FROM dirty) WHERE rn = 1""")
def _(lake: Lake) -> DataFrame:
    rows = lake.dirty.withColumn("copy_no", F.col("copy_no").cast("int"))
    kept = clean.keep_first(rows, FACT_KEY, ["copy_no", "event_id"])
    return _wide(kept.select("event_id", "userid", "adgroup_id", F.col("_us").alias("us"), "click", "copy_no"))


@query("b03_dim_keep_last", f"""WITH {ADS}, doubled AS (
       SELECT *, 0 AS ord FROM raw_ads UNION ALL
       SELECT adgroup_id, cate_id, campaign_id + 1000, customer, brand, price + 1, 1 AS ord FROM raw_ads WHERE adgroup_id % 3 = 0)
       SELECT adgroup_id, cate_id, campaign_id, customer, brand, {r6('price')} AS price FROM (
       SELECT *, row_number() OVER (PARTITION BY adgroup_id ORDER BY ord DESC) AS rn FROM doubled) WHERE rn = 1""")
def _(lake: Lake) -> DataFrame:
    ads = bindings.raw_ads(lake.spark, lake.folder)
    again = ads.where(F.col("adgroup_id") % 3 == 0).withColumns({"campaign_id": F.col("campaign_id") + 1000, "price": F.col("price") + 1})
    both = ads.withColumn("ord", F.lit(0)).unionByName(again.withColumn("ord", F.lit(1)))
    return clean.keep_last(both, ["adgroup_id"], ["ord"]).drop("ord").withColumn("price", six(F.col("price")))


@query("b04_binary_click", f"""WITH {IMP}, odd AS (SELECT CASE WHEN event_id % 100 = 0 THEN 2 WHEN event_id % 100 = 1 THEN NULL ELSE click END AS click FROM imp)
       SELECT count(*) AS n, count(*) FILTER (WHERE NOT COALESCE(click IN (0, 1), false)) AS broken FROM odd""")
def _(lake: Lake) -> DataFrame:
    left = F.col("event_id") % 100
    odd = lake.imp.select(F.when(left == 0, 2).when(left == 1, None).otherwise(F.col("click")).alias("click"))
    return clean.violations(odd, n=F.lit(False), broken=clean.is_binary())


@query("b05_positive_price", f"""WITH {ADS}, odd AS (SELECT CASE WHEN adgroup_id % 50 = 0 THEN 0 WHEN adgroup_id % 50 = 1 THEN NULL ELSE price END AS price FROM raw_ads)
       SELECT count(*) AS n, count(*) FILTER (WHERE NOT COALESCE(price > 0, false)) AS broken FROM odd""")
def _(lake: Lake) -> DataFrame:
    left = F.col("adgroup_id") % 50
    odd = bindings.raw_ads(lake.spark, lake.folder).select(F.when(left == 0, 0.0).when(left == 1, None).otherwise(F.col("price")).alias("price"))
    return clean.violations(odd, n=F.lit(False), broken=clean.is_positive())


@query("b06_unknown_codes", f"""WITH {ADS}, {USERS}
       SELECT 'ad' AS side, adgroup_id AS id, brand AS code FROM ads UNION ALL
       SELECT 'pvalue', userid, pvalue_level FROM users UNION ALL SELECT 'class', userid, new_user_class_level FROM users""")
def _(lake: Lake) -> DataFrame:
    side = lambda df, name, key, code: df.select(F.lit(name).alias("side"), F.col(key).alias("id"), F.col(code).alias("code"))
    return side(lake.ads, "ad", "adgroup_id", "brand").unionAll(side(lake.users, "pvalue", "userid", "pvalue_level")).unionAll(
        side(lake.users, "class", "userid", "new_user_class_level")
    )


@query("b07_zero_segment", f"WITH {USERS} SELECT cms_segid, count(*) AS n FROM users GROUP BY 1")
def _(lake: Lake) -> DataFrame:
    raw = bindings.raw_users(lake.spark, lake.folder).withColumn("_row", F.col("userid"))
    return clean.clean_users(raw, ["_row"]).groupBy("cms_segid").agg(N().alias("n"))


@query("b08_category_text", f"""WITH {USERS} SELECT userid, COALESCE(CAST(pvalue_level AS VARCHAR), '-1') AS pvalue_level,
       COALESCE(CAST(new_user_class_level AS VARCHAR), '-1') AS new_user_class_level, CAST(age_level AS VARCHAR) AS age_level FROM raw_users""")
def _(lake: Lake) -> DataFrame:
    raw = bindings.raw_users(lake.spark, lake.folder)
    return raw.select("userid", *[category_text(F.col(c)).alias(c) for c in ("pvalue_level", "new_user_class_level", "age_level")])


@query("b09_split_filter", f"WITH {IMP} SELECT event_id, userid, click FROM imp WHERE _split = 'train'")
def _(lake: Lake) -> DataFrame:
    return _wide(lake.imp.where(is_train()).select("event_id", "userid", "click"))


@query("b10_numbered_queries", f"""WITH {IMP} SELECT row_number() OVER (ORDER BY us, event_id) - 1 AS query_id, event_id, adgroup_id AS true_adgroup_id
       FROM imp WHERE _split = 'test' AND click = 1""")
def _(lake: Lake) -> DataFrame:
    return numbered_queries(lake.gold).select("query_id", "event_id", F.col("adgroup_id_key").alias("true_adgroup_id"))


@query("b11_key_stash", f"""WITH {ENCODED} SELECT event_id, userid AS userid_key, adgroup_id AS adgroup_id_key, click,
       {', '.join(r6(c + '_te') + f' AS {c}_te' for c in ['userid', 'adgroup_id', 'campaign_id', 'customer'])} FROM encoded""")
def _(lake: Lake) -> DataFrame:
    rows = lake.star.select("event_id", "_split", "click", "userid", "adgroup_id", "campaign_id", "customer")
    out = encode_ids(rows, lake.prior).drop("_split")
    return _wide(out.withColumns({c: six(F.col(c)) for c in out.columns if c.endswith("_te")}))


@query("b13_division_guard", f"""WITH {IMP} SELECT adgroup_id, {r6("COALESCE(sum(CASE WHEN _split = 'test' THEN click END) / NULLIF(CAST(count(CASE WHEN _split = 'test' AND userid % 7 = 0 THEN 1 END) AS DOUBLE), 0), -1)")} AS rate
       FROM imp GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    test = ~is_train()
    sums = lake.imp.groupBy("adgroup_id").agg(
        F.sum(F.when(test, F.col("click"))).alias("c"), F.count(F.when(test & (F.col("userid") % 7 == 0), 1)).alias("n")
    )
    return sums.select("adgroup_id", six(ratio(F.col("c"), F.col("n"), -1.0)).alias("rate"))


@query("b14_time_split", f"""WITH {IMP}, placed AS (SELECT *, row_number() OVER (ORDER BY us, event_id) - 1 AS pos, count(*) OVER () AS n FROM imp)
       SELECT CASE WHEN pos < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part, count(*) AS n, min(us) AS first_us, max(us) AS last_us,
       {big('sum(click)')} AS clicks FROM placed GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    rows = lake.imp.select("event_id", "_us", "click")
    total = rows.agg(N()).scalar()
    placed = row_position(rows, ("_us", "event_id"), lake.timeline)
    part = F.when(F.col("position") < F.floor(total * F.lit(0.8)), "train").otherwise("test")
    return placed.groupBy(part.alias("part")).agg(
        N().alias("n"), F.min("_us").alias("first_us"), F.max("_us").alias("last_us"), F.sum("click").alias("clicks")
    )


@query("b15_frequent_ads", f"""WITH {IMP}, top AS (SELECT adgroup_id FROM imp GROUP BY 1 ORDER BY count(*) DESC, adgroup_id LIMIT 30)
       SELECT event_id, adgroup_id, click FROM imp WHERE adgroup_id IN (SELECT adgroup_id FROM top)""")
def _(lake: Lake) -> DataFrame:
    return _wide(clean.restrict_to_frequent(lake.imp.select("event_id", "adgroup_id", "click"), size=30))


@query("b16_duplicate_keys", f"WITH {DIRTY} SELECT userid, us, count(*) AS n FROM dirty GROUP BY 1, 2 HAVING count(*) > 1")
def _(lake: Lake) -> DataFrame:
    return clean.duplicate_keys(lake.dirty.withColumnRenamed("_us", "us"), ["userid", "us"])


# Impressions of ads that no dimension row describes, next to all given ones.
ORPHANS = "orphans AS (SELECT event_id, adgroup_id FROM imp UNION ALL SELECT -1 - event_id, -1 - adgroup_id FROM imp WHERE click = 1)"


def with_orphans(lake: Lake) -> DataFrame:
    rows = lake.imp.select("event_id", "adgroup_id")
    return rows.union(lake.imp.where(F.col("click") == 1).select(-1 - F.col("event_id"), -1 - F.col("adgroup_id")))


@query("c01_left_join", f"WITH {IMP},{ADS},{ORPHANS} SELECT event_id, adgroup_id, cate_id, price FROM orphans LEFT JOIN ads USING (adgroup_id)")
def _(lake: Lake) -> DataFrame:
    return with_orphans(lake).join(lake.ads.select("adgroup_id", "cate_id", "price"), "adgroup_id", "left")


@query("c02_lookup_default", f"""WITH {IMP},{ORPHANS}, s AS (SELECT adgroup_id, avg(click) AS v FROM imp WHERE _split = 'train' GROUP BY 1),
       g AS (SELECT avg(click) AS gm FROM imp WHERE _split = 'train')
       SELECT event_id, {r6('COALESCE(v, gm)')} AS rate FROM orphans LEFT JOIN s USING (adgroup_id) CROSS JOIN g""")
def _(lake: Lake) -> DataFrame:
    stats = lake.imp.where(is_train()).groupBy("adgroup_id").agg(F.avg("click").alias("rate"))
    out = lookup(with_orphans(lake), stats, ["adgroup_id"], defaults={"rate": lake.prior})
    return out.select("event_id", six(F.col("rate")).alias("rate"))


@query("c03_composite_lookup", f"""WITH {STAR}, s AS (SELECT userid, cate_id, sum(click) AS c, count(*) AS n FROM star WHERE _split = 'train' GROUP BY 1, 2)
       SELECT event_id, {big('COALESCE(c, 0)')} AS clicks, COALESCE(n, 0) AS n FROM star LEFT JOIN s USING (userid, cate_id) WHERE _split = 'test'""")
def _(lake: Lake) -> DataFrame:
    rows = lake.star.select("event_id", "userid", "cate_id", "click", "_split")
    stats = rows.where(is_train()).groupBy("userid", "cate_id").agg(F.sum("click").alias("clicks"), N().alias("n"))
    out = lookup(rows.where(~is_train()), stats, ["userid", "cate_id"], defaults={"clicks": F.lit(0), "n": F.lit(0)})
    return out.select("event_id", "clicks", "n")


@query("c04_query_catalog", f"""WITH {QUERIES} SELECT query_id, count(*) AS n_candidates, {r6('sum(c_price)')} AS price_sum,
       {r6('sum(ag_ctr_before)')} AS ctr_sum, {big('max(adgroup_id)')} AS max_ad FROM cand GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    rows = with_candidates(click_queries(lake.gold), lake.lookups)
    total = lambda f: F.sum(F.aggregate("candidates", F.lit(0.0), lambda a, c: a + c[f]))
    return rows.groupBy("query_id").agg(
        F.sum(F.size("candidates")).alias("n_candidates"), six(total("price")).alias("price_sum"), six(total("ag_ctr_before")).alias("ctr_sum"),
        F.max(F.array_max(F.transform("candidates", lambda c: c["adgroup_id"]))).alias("max_ad"),
    )


@query("c05_semi_join", f"WITH {IMP},{USERS} SELECT userid, age_level FROM users WHERE userid IN (SELECT userid FROM imp WHERE click = 1)")
def _(lake: Lake) -> DataFrame:
    clicked = lake.imp.where(F.col("click") == 1)
    return profile.active_users(lake.users, clicked).select("userid", "age_level")


@query("c06_snapshot_join", f"""WITH {CATALOG} SELECT p.adgroup_id_key AS adgroup_id, p.cate_id, {big('c.cate_clicks_before')} AS cate_clicks_before, c.cate_impressions_before
       FROM products p LEFT JOIN cates c USING (cate_id)""")
def _(lake: Lake) -> DataFrame:
    return product_snapshot(lake.gold).join(category_snapshot(lake.gold), "cate_id", "left").select(
        "adgroup_id", "cate_id", "cate_clicks_before", "cate_impressions_before"
    )


@query("c07_inner_join", f"""WITH {GOLD}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY adgroup_id_key ORDER BY us DESC, event_id DESC) AS rn FROM gold) WHERE rn = 1)
       SELECT adgroup_id, a.cate_id, a.brand, a.price, ag_impressions_before FROM l JOIN ads a ON a.adgroup_id = l.adgroup_id_key""")
def _(lake: Lake) -> DataFrame:
    latest = profile.ad_snapshot(lake.gold, ["ag_impressions_before"])
    return latest.join(lake.ads, "adgroup_id", "inner").select("adgroup_id", "cate_id", "brand", "price", "ag_impressions_before")


@query("c08_true_rank", f"WITH {QUERIES},{ranks('score')} SELECT query_id, true_adgroup_id, rank, catalog_size FROM ranks")
def _(lake: Lake) -> DataFrame:
    return true_ranks(click_queries(lake.gold), lake.lookups, linear_score)


@query("c09_as_of_state", f"""WITH {IMP}, s AS (SELECT DISTINCT userid FROM imp), p AS (SELECT userid, epoch_us(TIMESTAMP '2024-01-25 00:00:00') AS us FROM s)
       SELECT p.userid, COALESCE(i.adgroup_id, -1) AS last_clicked FROM p ASOF LEFT JOIN (SELECT * FROM imp WHERE click = 1) i ON p.userid = i.userid AND p.us > i.us""")
def _(lake: Lake) -> DataFrame:
    # The state of a key before one instant is its last row before it: an aggregate, no join.
    return lake.imp.groupBy("userid").agg(
        F.max_by("adgroup_id", F.when(is_train() & (F.col("click") == 1), F.struct("_us", "event_id"))).alias("last_clicked")
    ).fillna(-1)


@query("c09_as_of_join", f"""WITH {IMP}, v AS (SELECT userid, us, max(event_id) AS event_id FROM imp WHERE click = 1 GROUP BY 1, 2), c AS (SELECT v.*, adgroup_id FROM v JOIN imp USING (event_id))
       SELECT i.event_id, COALESCE(c.adgroup_id, -1) AS last_clicked, {big('COALESCE(c.us, -1)')} AS clicked_us FROM imp i ASOF LEFT JOIN c ON i.userid = c.userid AND i.us > c.us""")
def _(lake: Lake) -> DataFrame:
    """The last click of the user before each impression, as a join of two tables on time."""
    clicks = lake.imp.where(F.col("click") == 1).select("userid", "_us", "event_id", F.col("adgroup_id").alias("last_clicked"), F.col("_us").alias("clicked_us"))
    out = as_of_join(lake.imp.select("event_id", "userid", "_us"), clicks, ["userid"], ["last_clicked", "clicked_us"], strict=True)
    return out.select("event_id", "last_clicked", "clicked_us").fillna(-1)
