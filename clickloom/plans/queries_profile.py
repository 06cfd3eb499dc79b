"""Aggregates and profiles (H)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.scalar import six
from clickloom.operators import profile
from clickloom.plans.lake import Lake
from clickloom.plans.oracle import GOLD, IMP, STAR, big, r6, values_of
from clickloom.plans.queries_history import tidy
from clickloom.plans.registry import query

USER_STATS = f"""{IMP},
stats AS (SELECT userid, count(*) AS impressions, sum(click) AS clicks, count(DISTINCT adgroup_id) AS n_ads FROM imp GROUP BY 1)"""
LATEST = f"""{GOLD},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY adgroup_id_key ORDER BY us DESC, event_id DESC) AS rn FROM gold) WHERE rn = 1)"""
AD_STATE = [
    "ag_clicks_before", "ag_impressions_before", "ag_ctr_before", "ag_revenue_before", "ag_impressions_last_1d",
    "ag_ctr_last_1d", "ag_impressions_last_3d", "ag_ctr_last_3d", "ag_ctr_trend_1d_vs_3d",
]


def everything(df: DataFrame) -> DataFrame:
    return tidy(df, *df.columns)


def snapshot(lake: Lake) -> DataFrame:
    state = profile.ad_snapshot(lake.gold, AD_STATE)
    return state.join(lake.ads.select("adgroup_id", "cate_id", "brand", "price"), "adgroup_id", "inner")


@query("h01_overview", f"""WITH {IMP} SELECT count(*) AS impressions, min(date) AS start_date, max(date) AS end_date, count(DISTINCT date) AS days,
       count(DISTINCT userid) AS users, count(DISTINCT adgroup_id) AS ads, count(*) FILTER (WHERE _split = 'train') AS train_rows,
       count(*) FILTER (WHERE _split = 'test') AS test_rows, {r6('avg(click)')} AS ctr FROM imp""")
def _(lake: Lake) -> DataFrame:
    out = profile.overview(lake.imp)
    return everything(out.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")}))


@query("h02_by_day", f"WITH {IMP} SELECT date, count(*) AS impressions, {r6('avg(click)')} AS ctr FROM imp GROUP BY 1")
def _(lake: Lake) -> DataFrame:
    return everything(profile.volume_and_ctr(lake.imp, "date").withColumn("date", F.col("date").cast("string")))


@query("h03_top_categories", f"WITH {STAR} SELECT cate_id, count(*) AS impressions, {r6('avg(click)')} AS ctr FROM star GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def _(lake: Lake) -> DataFrame:
    return everything(profile.top_by_volume(lake.star, "cate_id"))


@query("h04_top_brands", f"WITH {STAR} SELECT brand, count(*) AS impressions, {r6('avg(click)')} AS ctr FROM star GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def _(lake: Lake) -> DataFrame:
    return everything(profile.top_by_volume(lake.star, "brand"))


@query("h05_ads_per_user", f"WITH {USER_STATS} SELECT n_ads, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 4) + 0.0 AS share FROM stats GROUP BY 1")
def _(lake: Lake) -> DataFrame:
    shares = profile.value_shares(profile.ads_per_user(lake.imp), "n_ads")
    return shares.withColumn("share", F.round("share", 4) + 0.0)


@query("h06_segments", " UNION ALL ".join(
    f"SELECT * FROM (WITH {STAR} SELECT '{c}' AS segment, CAST({c} AS VARCHAR) AS level, count(*) AS impressions, {r6('avg(click)')} AS ctr FROM star GROUP BY 2)"
    for c in ["final_gender_code", "age_level", "shopping_level", "occupation", "pvalue_level", "new_user_class_level"]))
def _(lake: Lake) -> DataFrame:
    return everything(profile.segment_ctr(lake.star))


@query("h07_user_stats", f"WITH {USER_STATS} SELECT userid, impressions, {big('clicks')} AS clicks, clicks > 0 AS clicked_at_least_once FROM stats")
def _(lake: Lake) -> DataFrame:
    return profile.user_stats(lake.imp)


@query("h08_customer_overview", f"""WITH {USER_STATS}, q AS (SELECT quantile_cont(impressions, 0.9) AS cut FROM stats), r AS (SELECT count(DISTINCT c_custkey) AS n FROM customer)
       SELECT count(*) AS active_users, {r6('avg(impressions)')} AS mean_impressions, {r6('avg(clicks)')} AS mean_clicks, {r6('avg(CAST(clicks > 0 AS INT))')} AS clicker_share,
       {big('sum(CAST(impressions = 1 AS INT))')} AS seen_once, {r6('avg(CAST(impressions = 1 AS INT))')} AS seen_once_share,
       {r6('sum(CASE WHEN impressions >= cut THEN impressions END) / CAST(sum(impressions) AS DOUBLE)')} AS top10_impression_share,
       {r6('sum(CASE WHEN impressions >= cut THEN clicks END) / CAST(sum(clicks) AS DOUBLE)')} AS top10_click_share,
       max(n) AS registered_users, {r6('count(*) / CAST(max(n) AS DOUBLE)')} AS active_share FROM stats CROSS JOIN q CROSS JOIN r""")
def _(lake: Lake) -> DataFrame:
    return everything(profile.customer_overview(lake.imp, lake.users))


@query("h09_impression_center", f"WITH {USER_STATS} SELECT {r6('avg(impressions)')} AS mean, {r6('median(impressions)')} AS median FROM stats")
def _(lake: Lake) -> DataFrame:
    return everything(profile.center(profile.impression_blocks(profile.user_stats(lake.imp)), "impressions", "users"))


def bins(value: str, n: int, table: str, weight: str = "count(*)") -> str:
    return f"""SELECT CAST(COALESCE(LEAST(floor(({value} - lo) / NULLIF(CAST(hi - lo AS DOUBLE), 0) * {n}), {n - 1}), 0) AS BIGINT) + 1 AS bin, {weight} AS n,
       min({value}) AS min_value, max({value}) AS max_value FROM {table} CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM {table}) GROUP BY 1"""


@query("h09_impression_histogram", f"WITH {USER_STATS} {bins('impressions', 40, 'stats')}")
def _(lake: Lake) -> DataFrame:
    return profile.histogram(profile.impression_blocks(profile.user_stats(lake.imp)), "impressions", 40, "users")


ORDERED = """o AS (SELECT impressions, row_number() OVER (ORDER BY impressions) AS i, count(*) OVER () AS n, sum(impressions) OVER () AS total,
       sum(impressions) OVER (ORDER BY impressions, userid ROWS UNBOUNDED PRECEDING) AS cum FROM stats)"""


@query("h10_gini", f"WITH {USER_STATS}, {ORDERED} SELECT max(n) AS users, {r6('(max(n) + 1 - 2 * sum(cum) / CAST(max(total) AS DOUBLE)) / max(n)')} AS gini FROM o")
def _(lake: Lake) -> DataFrame:
    return everything(profile.gini(profile.user_stats(lake.imp)))


@query("h11_lorenz", f"""WITH {USER_STATS}, {ORDERED} SELECT impressions, {r6('max(i) / CAST(max(n) AS DOUBLE)')} AS cum_users,
       {r6('max(cum) / CAST(max(total) AS DOUBLE)')} AS cum_impressions FROM o GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    return everything(profile.lorenz(profile.user_stats(lake.imp)))


@query("h11_top_share", f"""WITH {USER_STATS}, o AS (SELECT impressions, row_number() OVER (ORDER BY impressions DESC) AS i, count(*) OVER () AS n, sum(impressions) OVER () AS total FROM stats)
       SELECT {big('max(floor(n * 0.2::DOUBLE))')} AS users, {r6('sum(CASE WHEN i <= floor(n * 0.2::DOUBLE) THEN impressions END) / CAST(max(total) AS DOUBLE)')} AS share FROM o""")
def _(lake: Lake) -> DataFrame:
    return everything(profile.top_share(profile.user_stats(lake.imp)))


def buckets(by: str, extra: str = "") -> str:
    edge = lambda e: f"floor(n * {e}::DOUBLE)"
    return f"""o AS (SELECT *, row_number() OVER (ORDER BY {by} DESC, userid) - 1 AS i, count(*) OVER () AS n FROM stats),
       b AS (SELECT *, CASE WHEN i < {edge(0.05)} THEN 'Top 0-5%' WHEN i < {edge(0.10)} THEN 'Top 5-10%' WHEN i < {edge(0.20)} THEN 'Top 10-20%'
             WHEN i < {edge(0.50)} THEN 'Top 20-50%' ELSE 'Top 50-100%' END AS bucket FROM o)
       SELECT bucket, count(*) AS users, {extra} {big('sum(impressions)')} AS impressions, {big('sum(clicks)')} AS clicks,
       {r6('sum(clicks) / CAST(sum(impressions) AS DOUBLE)')} AS ctr FROM b GROUP BY 1"""


@query("h12_frequency_buckets", f"WITH {USER_STATS}, {buckets('impressions')}")
def _(lake: Lake) -> DataFrame:
    return everything(profile.bucket_ctr(profile.user_stats(lake.imp)))


@query("h13_diversity_buckets", f"WITH {USER_STATS}, {buckets('n_ads', r6('avg(n_ads)') + ' AS mean_n_ads,')}")
def _(lake: Lake) -> DataFrame:
    return everything(profile.bucket_ctr(profile.ads_per_user(lake.imp), "n_ads", "n_ads"))


STATE_SQL = ", ".join(f"{big(c)} AS {c}" if "clicks" in c or "impressions" in c else f"{r6(c)} AS {c}" for c in AD_STATE)


@query("h14_ad_snapshot", f"WITH {LATEST} SELECT adgroup_id_key AS adgroup_id, {STATE_SQL}, cate_id, brand, {r6('price')} AS price FROM latest")
def _(lake: Lake) -> DataFrame:
    return everything(snapshot(lake))


TREND = "ag_ctr_trend_1d_vs_3d"


@query("h15_trending", f"""WITH {LATEST} SELECT * FROM (SELECT adgroup_id_key AS adgroup_id, 'heating' AS direction, {r6(TREND)} AS trend FROM latest ORDER BY {TREND} DESC, 1 LIMIT 10)
       UNION ALL SELECT * FROM (SELECT adgroup_id_key, 'cooling', {r6(TREND)} FROM latest ORDER BY {TREND}, 1 LIMIT 10)""")
def _(lake: Lake) -> DataFrame:
    return profile.trending(snapshot(lake)).select("adgroup_id", "direction", six(F.col(TREND)).alias("trend"))


@query("h16_leader_overlap", f"""WITH {LATEST} SELECT adgroup_id_key AS adgroup_id FROM (SELECT adgroup_id_key FROM latest ORDER BY ag_impressions_before DESC, adgroup_id_key LIMIT 15)
       INTERSECT SELECT adgroup_id_key FROM (SELECT adgroup_id_key FROM latest ORDER BY ag_revenue_before DESC, adgroup_id_key LIMIT 15)""")
def _(lake: Lake) -> DataFrame:
    return profile.leader_overlap(snapshot(lake))


@query("h16_leaders", f"""WITH {LATEST} SELECT * FROM (SELECT 'volume' AS list, adgroup_id_key AS adgroup_id, {r6('price')} AS price, ag_impressions_before, {r6('ag_revenue_before')} AS ag_revenue_before
       FROM latest ORDER BY latest.ag_impressions_before DESC, adgroup_id_key LIMIT 15) UNION ALL
       SELECT * FROM (SELECT 'revenue', adgroup_id_key, {r6('price')}, ag_impressions_before, {r6('ag_revenue_before')} FROM latest ORDER BY latest.ag_revenue_before DESC, adgroup_id_key LIMIT 15)""")
def _(lake: Lake) -> DataFrame:
    state = snapshot(lake)
    columns = ["adgroup_id", "price", "ag_impressions_before", "ag_revenue_before"]
    lists = [profile.leaders(state, f"ag_{c}_before").withColumn("list", F.lit(n)) for n, c in (("volume", "impressions"), ("revenue", "revenue"))]
    return everything(lists[0].unionByName(lists[1]).select("list", *columns))


@query("h17_ctr_range", f"""WITH {IMP}, a AS (SELECT adgroup_id, count(*) AS n, avg(click) AS ctr FROM imp GROUP BY 1 HAVING count(*) >= 100)
       SELECT count(*) AS ads, {r6('min(ctr)')} AS min_ctr, {r6('max(ctr)')} AS max_ctr FROM a""")
def _(lake: Lake) -> DataFrame:
    return everything(profile.ctr_range(lake.imp, support=100))


@query("h18_price_deciles", f"""WITH {STAR},{values_of(['price'], 'star')} SELECT CAST(floor(n_below * 10 / CAST(n_total AS DOUBLE)) AS BIGINT) + 1 AS decile, count(*) AS price_levels,
       {big('sum(n)')} AS impressions, {r6('sum(pos) / CAST(sum(n) AS DOUBLE)')} AS ctr FROM vals GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    return everything(profile.price_deciles(lake.star.select("price", "click")))


def relabel(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count(*) AS values, count(*) FILTER (WHERE n = 1) AS single, {r6('avg(CAST(n = 1 AS INT))')} AS share
       FROM (SELECT {c}, count(DISTINCT adgroup_id) AS n FROM star GROUP BY 1)"""


@query("h19_relabeling", f"WITH {STAR} " + " UNION ALL ".join(relabel(c) for c in ("campaign_id", "customer", "brand")))
def _(lake: Lake) -> DataFrame:
    return everything(profile.relabeling(lake.star, ["campaign_id", "customer", "brand"]))


@query("h20_mix_shift", f"""WITH {IMP}, c AS (SELECT adgroup_id, count(*) FILTER (WHERE _split = 'train') AS a, count(*) FILTER (WHERE _split = 'test') AS b FROM imp GROUP BY 1),
       t AS (SELECT CAST(sum(a) AS DOUBLE) AS sa, CAST(sum(b) AS DOUBLE) AS sb FROM c) SELECT {r6('sum(abs(a / sa - b / sb)) / 2')} AS tvd FROM c CROSS JOIN t""")
def _(lake: Lake) -> DataFrame:
    return everything(profile.mix_shift(lake.imp))


def gap(c: str) -> str:
    gone, there = f"CASE WHEN {c} = 'unknown' THEN click END", f"CASE WHEN {c} <> 'unknown' THEN click END"
    return f"""SELECT '{c}' AS "column", count({gone}) AS missing_rows, {r6(f'avg({gone})')} AS missing_ctr, {r6(f'avg({there})')} AS present_ctr,
       {r6(f'avg({gone}) - avg({there})')} AS gap FROM star"""


@query("h21_missing_gap", f"WITH {STAR} " + " UNION ALL ".join(gap(c) for c in ("brand", "pvalue_level", "new_user_class_level")))
def _(lake: Lake) -> DataFrame:
    return everything(profile.missing_gap(lake.star, ["brand", "pvalue_level", "new_user_class_level"]))


def cover(name: str, table: str, key: str, column: str) -> str:
    return f"""SELECT '{name}' AS side, count(*) AS catalog, count(s.k) AS seen, {r6('count(s.k) / CAST(count(*) AS DOUBLE)')} AS share
       FROM {table} LEFT JOIN (SELECT DISTINCT {column} AS k FROM imp) s ON s.k = {key}"""


@query("h22_coverage", f"WITH {IMP} " + cover("ads", "part", "p_partkey", "adgroup_id") + " UNION ALL " + cover("users", "customer", "c_custkey", "userid"))
def _(lake: Lake) -> DataFrame:
    ads = profile.coverage(lake.ads, lake.imp, "adgroup_id").withColumn("side", F.lit("ads"))
    return everything(ads.unionByName(profile.coverage(lake.users, lake.imp, "userid").withColumn("side", F.lit("users"))))


@query("h22_never_seen", f"WITH {IMP} SELECT p_partkey AS adgroup_id FROM part WHERE p_partkey NOT IN (SELECT adgroup_id FROM imp)")
def _(lake: Lake) -> DataFrame:
    return profile.never_seen(lake.ads, lake.imp, "adgroup_id")


@query("h23_daily_spread", f"""WITH {IMP}, d AS (SELECT date, avg(click) AS ctr FROM imp GROUP BY 1) SELECT count(*) AS days, {r6('min(ctr)')} AS min_ctr, {r6('max(ctr)')} AS max_ctr,
       {r6('stddev_samp(ctr)')} AS std_ctr FROM d""")
def _(lake: Lake) -> DataFrame:
    return everything(profile.daily_spread(lake.imp))


@query("h24_exposure_points", f"WITH {LATEST} SELECT adgroup_id_key AS adgroup_id, ag_impressions_before, {r6('ag_ctr_before')} AS ag_ctr_before FROM latest")
def _(lake: Lake) -> DataFrame:
    return everything(profile.ad_snapshot(lake.gold, ["ag_impressions_before", "ag_ctr_before"]))


@query("h24_ctr_histogram", f"WITH {LATEST}, x AS (SELECT {r6('ag_ctr_before')} AS v FROM latest) {bins('v', 30, 'x')}")
def _(lake: Lake) -> DataFrame:
    state = profile.ad_snapshot(lake.gold, ["ag_ctr_before"]).select(six(F.col("ag_ctr_before")).alias("v"))
    return profile.histogram(state, "v", 30)
