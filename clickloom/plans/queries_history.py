"""Point-in-time features (G) and the window, set and reshape primitives (W, K)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.constants import DAY_US, GOLD_COLUMNS, GROUPED_FEATURES, INTERACTIONS
from clickloom.functions.scalar import fold_of, ratio, six
from clickloom.operators import coclick, encode, history, profile
from clickloom.operators.encode import is_train
from clickloom.operators.prefix import ROW_ORDER, Timeline, by_value, global_rank, running
from clickloom.operators.ranking import top_per_group
from clickloom.plans.lake import Lake
from clickloom.plans.oracle import ADS, CATALOG, DAY, ENCODED, FOLD, GOLD, HISTORY, IMP, STAR, big, prefix, r6, trailing
from clickloom.plans.registry import query
from clickloom.sources import bindings

N = lambda: F.count(F.lit(1))


def tidy(df: DataFrame, *columns: str) -> DataFrame:
    """Comparable output: doubles rounded, integers as bigint, strings untouched."""
    kinds = dict(df.dtypes)
    out = []
    for c in columns:
        kind = kinds[c]
        value = six(F.col(c)) if kind == "double" else F.col(c).cast("bigint") if kind in ("int", "tinyint", "smallint") else F.col(c)
        out.append(value.alias(c))
    return df.select(*out)


def feat(*columns: str, table: str = "feat", cte: str = HISTORY, ints: tuple[str, ...] = ()) -> str:
    parts = [f"{big(c)} AS {c}" if c in ints else f"{r6(c)} AS {c}" for c in columns]
    return f"WITH {cte} SELECT event_id, {', '.join(parts)} FROM {table}"


@query("g01_train_mean", f"WITH {IMP} SELECT {r6('avg(click)')} AS gm FROM imp WHERE _split = 'train'")
def _(lake: Lake) -> DataFrame:
    return lake.imp.where(is_train()).agg(six(F.avg("click")).alias("gm"))


@query("g02_smoothed_mean", f"""WITH {STAR} SELECT campaign_id, {r6('(sum(click) + max(gm) * 20.0::DOUBLE) / (count(*) + 20.0::DOUBLE)')} AS te
       FROM star CROSS JOIN gm WHERE _split = 'train' GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    train = lake.star.where(is_train()).groupBy("campaign_id").agg(F.sum("click").alias("c"), N().alias("n"))
    return train.select("campaign_id", six(encode.smoothed(F.col("c"), F.col("n"), lake.prior, 20)).alias("te"))


@query("g03_out_of_fold", f"WITH {ENCODED} SELECT event_id, {r6('customer_te')} AS customer_te FROM encoded WHERE _split = 'train'")
def _(lake: Lake) -> DataFrame:
    rows = lake.star.select("event_id", "_split", "click", "customer")
    return tidy(encode.target_encode(rows, ["customer"], lake.prior).where(is_train()), "event_id", "customer_te")


@query("g04_folds", f"WITH {IMP} SELECT event_id, {FOLD} AS fold FROM imp WHERE _split = 'train'")
def _(lake: Lake) -> DataFrame:
    return lake.imp.where(is_train()).select("event_id", fold_of(F.col("event_id")).cast("bigint").alias("fold"))


@query("g05_encoded_ids", feat("userid_te", "adgroup_id_te", "campaign_id_te", "customer_te", table="encoded", cte=ENCODED))
def _(lake: Lake) -> DataFrame:
    rows = lake.star.select("event_id", "_split", "click", "userid", "adgroup_id", "campaign_id", "customer")
    return tidy(encode.encode_ids(rows, lake.prior), "event_id", "userid_te", "adgroup_id_te", "campaign_id_te", "customer_te")


COUNTS = [f"{p}_{m}_before" for p in ("ag", "cate", "user") for m in ("clicks", "impressions")]


@query("g06_counts_before", feat(*COUNTS, ints=tuple(COUNTS)))
def _(lake: Lake) -> DataFrame:
    out = lake.arranged("cate_id")
    for key, name in (("adgroup_id", "ag"), ("cate_id", "cate"), ("userid", "user")):
        out = history.click_history(out, [key], name, lake.prior, lake.chunked("cate_id"))
    return tidy(out, "event_id", *COUNTS)


@query("g07_ctr_before", feat("ag_ctr_before", "cate_ctr_before", "user_ctr_before"))
def _(lake: Lake) -> DataFrame:
    out = lake.arranged("cate_id")
    for key, name in (("adgroup_id", "ag"), ("cate_id", "cate"), ("userid", "user")):
        out = history.click_history(out, [key], name, lake.prior, lake.chunked("cate_id"))
    return tidy(out, "event_id", "ag_ctr_before", "cate_ctr_before", "user_ctr_before")


@query("g08_revenue_before", feat("ag_revenue_before"))
def _(lake: Lake) -> DataFrame:
    rows = lake.arranged("price")
    return tidy(running(rows, ["adgroup_id"], {"ag_revenue_before": F.col("price") * F.col("click")}, base=lake.chunked("price")), "event_id", "ag_revenue_before")


def _trailing(lake: Lake, looks: dict[str, int] = history.LOOK_BACKS) -> DataFrame:
    rows = lake.imp.select("event_id", "_us", "adgroup_id", "click")
    return history.windowed_history(rows, "adgroup_id", "ag", lake.prior, lake.timeline, looks)


@query("g09_impressions_1d", feat("ag_impressions_last_1d", ints=("ag_impressions_last_1d",)))
def _(lake: Lake) -> DataFrame:
    return tidy(_trailing(lake, {"1d": DAY_US}), "event_id", "ag_impressions_last_1d")


@query("g10_ctr_1d", feat("ag_ctr_last_1d"))
def _(lake: Lake) -> DataFrame:
    return tidy(_trailing(lake, {"1d": DAY_US}), "event_id", "ag_ctr_last_1d")


@query("g11_window_3d", feat("ag_impressions_last_3d", "ag_ctr_last_3d", ints=("ag_impressions_last_3d",)))
def _(lake: Lake) -> DataFrame:
    return tidy(_trailing(lake, {"3d": 3 * DAY_US}), "event_id", "ag_impressions_last_3d", "ag_ctr_last_3d")


@query("g12_ctr_trend", feat("ag_ctr_trend_1d_vs_3d"))
def _(lake: Lake) -> DataFrame:
    return tidy(history.ctr_trend(_trailing(lake)), "event_id", "ag_ctr_trend_1d_vs_3d")


@query("g13_previous_click", f"WITH {HISTORY} SELECT event_id, COALESCE(user_prev_clicked_item, -1) AS user_prev_clicked_item FROM feat")
def _(lake: Lake) -> DataFrame:
    rows = coclick.with_previous_click(lake.arranged(), lake.chunked())
    return rows.select("event_id", F.coalesce(coclick.PREV, F.lit(-1)).alias(coclick.PREV))


@query("g14_coclick_affinity", feat("item_coclick_affinity"))
def _(lake: Lake) -> DataFrame:
    rows = coclick.with_previous_click(lake.arranged(), lake.chunked())
    return tidy(coclick.with_coclick_affinity(rows), "event_id", "item_coclick_affinity")


@query("g15_coclick_snapshot", f"WITH {CATALOG} SELECT prev_item, item, {big('cnt')} AS cnt, {big('total')} AS total FROM snap")
def _(lake: Lake) -> DataFrame:
    return coclick.coclick_snapshot(coclick.with_previous_click(lake.arranged(), lake.chunked()))


def _affinity(key: str, name: str) -> str:
    columns = [f"{name}_clicks_before", f"{name}_impressions_before"]
    return feat(*columns, f"{name}_affinity_before", ints=tuple(columns))


@query("g16_user_category_affinity", _affinity("cate_id", "user_cate"))
def _(lake: Lake) -> DataFrame:
    out = history.affinity_history(lake.arranged("cate_id"), ["userid", "cate_id"], "user_cate", lake.prior, lake.chunked("cate_id"))
    return tidy(out, "event_id", "user_cate_clicks_before", "user_cate_impressions_before", "user_cate_affinity_before")


@query("g17_user_brand_affinity", _affinity("brand", "user_brand"))
def _(lake: Lake) -> DataFrame:
    out = history.affinity_history(lake.arranged("brand"), ["userid", "brand"], "user_brand", lake.prior, lake.chunked("brand"))
    return tidy(out, "event_id", "user_brand_clicks_before", "user_brand_impressions_before", "user_brand_affinity_before")


@query("g18_clicked_price_before", feat("user_avg_clicked_price_before"))
def _(lake: Lake) -> DataFrame:
    return tidy(history.user_history(lake.arranged("price"), lake.prior, lake.mean_price, lake.chunked("price")), "event_id", "user_avg_clicked_price_before")


@query("g19_price_gap", feat("user_price_gap"))
def _(lake: Lake) -> DataFrame:
    return tidy(history.user_history(lake.arranged("price"), lake.prior, lake.mean_price, lake.chunked("price")), "event_id", "user_price_gap")


FREQS = [f"{a}_x_{b}_freq" for a, b in INTERACTIONS]


@query("g20_interactions", feat(*FREQS))
def _(lake: Lake) -> DataFrame:
    rows = lake.star.select("event_id", "_split", "pid", "cate_id", "age_level", "brand", "cms_group_id")
    return tidy(encode.frequency_encode(rows, INTERACTIONS), "event_id", *FREQS)


GOLD_TEXT = [c for c in GOLD_COLUMNS if c not in ("time_stamp",)]
GOLD_INTS = {
    "userid_key", "adgroup_id_key", "user_prev_clicked_item", "click", *[f"{p}_{m}_before" for p in ("ag", "cate", "user") for m in ("clicks", "impressions")],
    "ag_impressions_last_1d", "ag_impressions_last_3d",
}
_NUMBERS = {c for c in GROUPED_FEATURES + ["userid_te", "adgroup_id_te", "campaign_id_te", "customer_te"]} - GOLD_INTS
GOLD_SQL = f"WITH {GOLD} SELECT us, " + ", ".join(
    f"{big(f'COALESCE({c}, -1)')} AS {c}" if c in GOLD_INTS else f"{r6(c)} AS {c}" if c in _NUMBERS else c for c in GOLD_TEXT
) + " FROM gold"


def checked_gold(gold: DataFrame) -> DataFrame:
    return tidy(gold.withColumn("us", F.unix_micros("time_stamp")).fillna(-1, [coclick.PREV]), "us", *GOLD_TEXT)


@query("g21_gold_table", GOLD_SQL)
def _(lake: Lake) -> DataFrame:
    return checked_gold(lake.build_gold())


@query("g21_gold_table_chunked", GOLD_SQL)
def _(lake: Lake) -> DataFrame:
    """The same over a forced number of chunks: the plan of a log that no task can hold."""
    return checked_gold(lake.build_gold(Timeline.of(lake.imp, pieces=12)))


CHUNKED = ("ag_clicks_before", "ag_impressions_before", "user_clicks_before", "user_impressions_before", "ag_impressions_last_1d")


@query("g06_counts_chunked", feat(*CHUNKED, ints=CHUNKED))
def _(lake: Lake) -> DataFrame:
    line = Timeline.of(lake.imp, pieces=12)
    rows = lake.imp.select("event_id", "_us", "userid", "adgroup_id", "click")
    out = history.windowed_history(rows, "adgroup_id", "ag", lake.prior, line, {"1d": DAY_US})
    return tidy(history.click_history(out, ["userid"], "user", lake.prior, line.chunked(rows)), "event_id", *CHUNKED)


@query("g22_brand_ctr", feat("brand_clicks_before", "brand_impressions_before", "brand_ctr_before", ints=("brand_clicks_before", "brand_impressions_before")))
def _(lake: Lake) -> DataFrame:
    out = history.click_history(lake.arranged("brand"), ["brand"], "brand", lake.prior, lake.chunked("brand"))
    return tidy(out, "event_id", "brand_clicks_before", "brand_impressions_before", "brand_ctr_before")


@query("g23_log_price", f"""WITH {STAR}, s AS (SELECT avg(ln(1 + price)) AS m, stddev_pop(ln(1 + price)) AS d FROM star WHERE _split = 'train')
       SELECT event_id, {r6('ln(1 + price)')} AS price_log, {r6('(ln(1 + price) - m) / d')} AS price_z FROM star CROSS JOIN s""")
def _(lake: Lake) -> DataFrame:
    rows = lake.star.select("event_id", "_split", "price")
    return tidy(encode.standardized_log_price(rows), "event_id", "price_log", "price_z")


@query("g24_count_encoding", f"""WITH {STAR}, n AS (SELECT count(*) AS n FROM star WHERE _split = 'train'),
       a AS (SELECT campaign_id, count(*) AS c FROM star WHERE _split = 'train' GROUP BY 1)
       SELECT event_id, COALESCE(c, 0) AS campaign_id_count, {r6('COALESCE(c, 0) / CAST(n AS DOUBLE)')} AS campaign_id_freq
       FROM star LEFT JOIN a USING (campaign_id) CROSS JOIN n""")
def _(lake: Lake) -> DataFrame:
    rows = lake.star.select("event_id", "_split", "campaign_id")
    out = encode.frequency_encode(encode.count_encode(rows, ["campaign_id"]), [["campaign_id"]], base=rows)
    return tidy(out, "event_id", "campaign_id_count", "campaign_id_freq")


@query("g25_pair_crosses", f"""WITH {STAR}, b AS (SELECT *, CAST(floor(price / 50) AS BIGINT) AS price_band FROM star),
       n AS (SELECT count(*) AS n FROM b WHERE _split = 'train'),
       x AS (SELECT price_band, pvalue_level, count(*) AS c FROM b WHERE _split = 'train' GROUP BY 1, 2),
       y AS (SELECT adgroup_id, cms_group_id, count(*) AS c FROM b WHERE _split = 'train' GROUP BY 1, 2)
       SELECT event_id, {r6('COALESCE(x.c, 0) / CAST(n AS DOUBLE)')} AS price_band_x_pvalue_level_freq,
              {r6('COALESCE(y.c, 0) / CAST(n AS DOUBLE)')} AS adgroup_id_x_cms_group_id_freq
       FROM b LEFT JOIN x USING (price_band, pvalue_level) LEFT JOIN y USING (adgroup_id, cms_group_id) CROSS JOIN n""")
def _(lake: Lake) -> DataFrame:
    rows = lake.star.select("event_id", "_split", "pvalue_level", "adgroup_id", "cms_group_id", F.floor(F.col("price") / 50).alias("price_band"))
    out = encode.frequency_encode(rows, [["price_band", "pvalue_level"], ["adgroup_id", "cms_group_id"]])
    return tidy(out, "event_id", "price_band_x_pvalue_level_freq", "adgroup_id_x_cms_group_id_freq")


def _width(h: int) -> str:
    w = trailing("adgroup_id", h * DAY // 24)
    return f"count(*) OVER {w} AS n{h}, COALESCE(sum(click) OVER {w}, 0) AS c{h}"


@query("g26_look_backs", f"""WITH {IMP}, gm AS (SELECT avg(click) AS gm FROM imp WHERE _split = 'train'),
       w AS (SELECT event_id, {_width(6)}, {_width(12)} FROM imp)
       SELECT event_id, n6 AS ag_impressions_last_6h, {r6('COALESCE(c6 / NULLIF(CAST(n6 AS DOUBLE), 0), gm)')} AS ag_ctr_last_6h,
              n12 AS ag_impressions_last_12h, {r6('COALESCE(c12 / NULLIF(CAST(n12 AS DOUBLE), 0), gm)')} AS ag_ctr_last_12h FROM w CROSS JOIN gm""")
def _(lake: Lake) -> DataFrame:
    out = _trailing(lake, {"6h": DAY_US // 4, "12h": DAY_US // 2})
    return tidy(out, "event_id", "ag_impressions_last_6h", "ag_ctr_last_6h", "ag_impressions_last_12h", "ag_ctr_last_12h")


def _lag(d: int) -> str:
    n, c = (f"n{d}", f"c{d}") if d == 1 else (f"(n{d} - n{d - 1})", f"(c{d} - c{d - 1})")
    return f"COALESCE({c} / NULLIF(CAST({n} AS DOUBLE), 0), gm)"


def _days(d: int) -> str:
    w = trailing("adgroup_id", d * DAY)
    return f"count(*) OVER {w} AS n{d}, COALESCE(sum(click) OVER {w}, 0) AS c{d}"


@query("g26_day_lags", f"""WITH {IMP}, gm AS (SELECT avg(click) AS gm FROM imp WHERE _split = 'train'),
       w AS (SELECT event_id, {_days(1)}, {_days(2)}, {_days(3)} FROM imp)
       SELECT event_id, {r6(_lag(1))} AS ag_ctr_t1, {r6(_lag(2))} AS ag_ctr_t2, {r6(_lag(3))} AS ag_ctr_t3,
              {r6(_lag(1) + ' - ' + _lag(2))} AS ag_ctr_t1_vs_t2, {r6(_lag(1) + ' - ' + _lag(3))} AS ag_ctr_t1_vs_t3 FROM w CROSS JOIN gm""")
def _(lake: Lake) -> DataFrame:
    rows = lake.imp.select("event_id", "_us", "adgroup_id", "click")
    out = history.day_lags(rows, "adgroup_id", "ag", lake.prior, lake.timeline)
    return tidy(out, "event_id", "ag_ctr_t1", "ag_ctr_t2", "ag_ctr_t3", "ag_ctr_t1_vs_t2", "ag_ctr_t1_vs_t3")


LINES = """
lines AS (
  SELECT epoch_us(o_orderdate) AS us, o_custkey AS userid, l_partkey AS adgroup_id, CAST(l_returnflag = 'R' AS BIGINT) AS click
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("g06_strict_ties", f"""WITH {LINES}, w AS (
       SELECT userid, us, click, count(*) OVER (PARTITION BY userid ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n,
              COALESCE(sum(click) OVER (PARTITION BY userid ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
              count(*) OVER {trailing("userid", 30 * DAY)} AS n30
       FROM lines)
       SELECT userid, us, count(*) AS n_rows, {big('max(n)')} AS impressions_before, {big('max(c)')} AS clicks_before, {big('max(n30)')} AS impressions_last_30d
       FROM w GROUP BY 1, 2""")
def _(lake: Lake) -> DataFrame:
    lines = bindings.order_lines(lake.spark, lake.folder).withColumn(
        "event_id", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate") % 1_000_000_007
    ).select("_us", "userid", "click", "event_id")
    out = history.windowed_history(lines, "userid", "user", F.lit(0.0), Timeline.of(lines, look_backs=[30 * DAY_US]), {"30d": 30 * DAY_US}, strict=True)
    return out.groupBy("userid", F.col("_us").alias("us")).agg(
        N().alias("n_rows"), F.max("user_impressions_before").cast("bigint").alias("impressions_before"),
        F.max("user_clicks_before").cast("bigint").alias("clicks_before"), F.max("user_impressions_last_30d").cast("bigint").alias("impressions_last_30d"),
    )


@query("w01_running_sum", f"WITH {IMP} SELECT event_id, {big(f'COALESCE(sum(click) OVER {prefix("pid")}, 0)')} AS clicks_before FROM imp")
def _(lake: Lake) -> DataFrame:
    return running(lake.arranged("pid"), ["pid"], {"clicks_before": F.col("click")}, base=lake.chunked("pid")).select("event_id", "clicks_before")


@query("w02_running_count", f"WITH {IMP} SELECT event_id, row_number() OVER (PARTITION BY pid ORDER BY us, event_id) - 1 AS shown_before FROM imp")
def _(lake: Lake) -> DataFrame:
    return running(lake.arranged("pid"), ["pid"], {"shown_before": F.lit(1)}, base=lake.chunked("pid")).select("event_id", "shown_before")


@query("w03_last_value_before", f"WITH {IMP} SELECT event_id, COALESCE(last_value(CASE WHEN click = 1 THEN userid END IGNORE NULLS) OVER {prefix('adgroup_id')}, -1) AS last_clicker FROM imp")
def _(lake: Lake) -> DataFrame:
    last = {"last_clicker": F.when(F.col("click") == 1, F.col("userid"))}
    return running(lake.arranged(), ["adgroup_id"], lasts=last, base=lake.chunked()).fillna(-1, ["last_clicker"]).select("event_id", "last_clicker")


@query("w04_mean_before", f"WITH {IMP} SELECT event_id, {r6(f'avg(click) OVER {prefix("userid")}')} AS mean_before FROM imp")
def _(lake: Lake) -> DataFrame:
    out = running(lake.arranged(), ["userid"], {"s": F.col("click"), "n": F.lit(1)}, base=lake.chunked())
    return out.select("event_id", six(ratio(F.col("s"), F.col("n"))).alias("mean_before"))


@query("w05_trailing_window", f"WITH {IMP} SELECT event_id, count(*) OVER {trailing('userid', DAY)} AS shown, {big(f'COALESCE(sum(click) OVER {trailing("userid", DAY)}, 0)')} AS clicks FROM imp")
def _(lake: Lake) -> DataFrame:
    rows = lake.imp.select("event_id", "_us", "userid", "click")
    out = history.windowed_history(rows, "userid", "user", lake.prior, lake.timeline, {"1d": DAY_US})
    return out.select("event_id", F.col("user_impressions_last_1d").alias("shown"), F.col("user_clicks_last_1d").alias("clicks"))


@query("w06_rank", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice, rank() OVER (ORDER BY l_extendedprice DESC) AS rank_of_price FROM lineitem")
def _(lake: Lake) -> DataFrame:
    lines = lake.table("lineitem")
    place = by_value(lines, ["l_extendedprice"], {"n": F.lit(1)}).select(
        F.col("value").alias("l_extendedprice"), (F.col("n_total") - F.col("n_below") - F.col("n") + 1).alias("rank_of_price")
    )
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").join(place, "l_extendedprice").withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


@query("w06_row_rank", f"""WITH {STAR} SELECT event_id, row_number() OVER (ORDER BY price DESC, event_id) - 1 AS rank FROM star""")
def _(lake: Lake) -> DataFrame:
    return global_rank(lake.star.select("event_id", "price"), "price", "event_id").select("event_id", "rank")


@query("w07_top_per_group", f"""WITH {STAR} SELECT userid, event_id, price, rn FROM (
       SELECT userid, event_id, price, row_number() OVER (PARTITION BY userid ORDER BY price DESC, event_id) AS rn FROM star) WHERE rn <= 3""")
def _(lake: Lake) -> DataFrame:
    rows = lake.star.select("userid", "event_id", "price")
    return tidy(top_per_group(rows, "userid", [F.desc("price"), F.col("event_id")], 3), "userid", "event_id", "price", "rn")


@query("w08_last_per_key", f"""WITH {IMP} SELECT userid, event_id, adgroup_id, click FROM (
       SELECT *, row_number() OVER (PARTITION BY userid ORDER BY us DESC, event_id DESC) AS rn FROM imp) WHERE rn = 1""")
def _(lake: Lake) -> DataFrame:
    last = lake.imp.groupBy("userid").agg(F.max_by(F.struct("event_id", "adgroup_id", "click"), F.struct(*ROW_ORDER)).alias("l"))
    return tidy(last.select("userid", "l.*"), "userid", "event_id", "adgroup_id", "click")


@query("w09_global_sort", f"WITH {STAR} SELECT event_id, price FROM star ORDER BY price, event_id")
def _(lake: Lake) -> DataFrame:
    return lake.star.select("event_id", "price").orderBy("price", "event_id")


@query("w10_head", f"WITH {IMP} SELECT event_id, us, userid FROM imp ORDER BY us DESC, event_id LIMIT 50")
def _(lake: Lake) -> DataFrame:
    return lake.imp.orderBy(F.desc("_us"), "event_id").limit(50).select("event_id", F.col("_us").alias("us"), "userid")


@query("w11_union_all", f"WITH {IMP} SELECT event_id, userid FROM imp WHERE click = 1 UNION ALL SELECT event_id, userid FROM imp WHERE pid = 'slot_0'")
def _(lake: Lake) -> DataFrame:
    rows = lake.imp.select("event_id", "userid", "click", "pid")
    return rows.where("click = 1").unionByName(rows.where("pid = 'slot_0'")).select("event_id", "userid")


@query("w12_intersection", f"WITH {IMP} SELECT userid, adgroup_id FROM imp WHERE _split = 'train' INTERSECT SELECT userid, adgroup_id FROM imp WHERE _split = 'test'")
def _(lake: Lake) -> DataFrame:
    pairs = lake.imp.select("userid", "adgroup_id", "_split")
    return pairs.where(is_train()).drop("_split").intersect(pairs.where(~is_train()).drop("_split"))


@query("w13_distinct", f"WITH {IMP} SELECT DISTINCT userid, adgroup_id FROM imp")
def _(lake: Lake) -> DataFrame:
    return lake.imp.select("userid", "adgroup_id").distinct()


@query("w14_value_shares", f"WITH {STAR} SELECT brand, count(*) AS n, {r6('count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)')} AS share FROM star GROUP BY 1")
def _(lake: Lake) -> DataFrame:
    return tidy(profile.value_shares(lake.star, "brand"), "brand", "n", "share")


@query("w15_reshape", f"""WITH {STAR}, s AS (SELECT cate_id, pid, count(*) AS n FROM star GROUP BY 1, 2)
       SELECT cate_id, {big("sum(CASE WHEN pid = 'slot_0' THEN n END)")} AS slot_0, {big("sum(CASE WHEN pid = 'slot_1' THEN n END)")} AS slot_1 FROM s GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    return lake.star.groupBy("cate_id").pivot("pid", ["slot_0", "slot_1"]).count()


@query("w15_unpivot", f"""WITH {IMP} SELECT event_id, 'hour' AS name, hour AS value FROM imp UNION ALL SELECT event_id, 'weekday', weekday FROM imp""")
def _(lake: Lake) -> DataFrame:
    rows = lake.imp.select("event_id", F.col("hour").cast("bigint").alias("hour"), F.col("weekday").cast("bigint").alias("weekday"))
    return rows.unpivot("event_id", ["hour", "weekday"], "name", "value")


@query("k01_text_keys", f"WITH {STAR} SELECT event_id, pid || '_' || cate_id AS pair, CAST(campaign_id AS VARCHAR) AS campaign FROM star")
def _(lake: Lake) -> DataFrame:
    return lake.star.select("event_id", F.concat_ws("_", "pid", "cate_id").alias("pair"), F.col("campaign_id").cast("string").alias("campaign"))


@query("k03_dates", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(isodow(o_orderdate) - 1 AS BIGINT) AS weekday,
       epoch_us(strptime(strftime(o_orderdate, '%Y-%m-%d') || ' 10:30:00', '%Y-%m-%d %H:%M:%S')) AS parsed_us FROM orders""")
def _(lake: Lake) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return lake.table("orders").select(
        "o_orderkey", day.alias("day"), F.year("o_orderdate").cast("bigint").alias("year"), F.weekday("o_orderdate").cast("bigint").alias("weekday"),
        F.unix_micros(F.to_timestamp(F.concat(day, F.lit(" 10:30:00")), "yyyy-MM-dd HH:mm:ss")).alias("parsed_us"),
    )


@query("k04_day_text", f"WITH {IMP} SELECT event_id, date AS dt FROM imp")
def _(lake: Lake) -> DataFrame:
    return lake.imp.select("event_id", F.date_format("time_stamp", "yyyy-MM-dd").alias("dt"))


@query("k05_null_fill", f"""WITH {ADS}
       SELECT adgroup_id, COALESCE(brand, -1) AS filled, brand IS NULL AS is_missing, {r6('COALESCE(brand / NULLIF(campaign_id, 0), 0)')} AS guarded FROM raw_ads""")
def _(lake: Lake) -> DataFrame:
    ads = bindings.raw_ads(lake.spark, lake.folder)
    return ads.select(
        "adgroup_id", F.coalesce("brand", F.lit(-1.0)).alias("filled"), F.col("brand").isNull().alias("is_missing"),
        six(ratio(F.col("brand"), F.col("campaign_id"), 0.0)).alias("guarded"),
    )


@query("k06_math", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r6('ln(1 + l_extendedprice)')} AS log1p, {r6('log2(l_quantity)')} AS log2,
       {r6('abs(l_discount - 0.05)')} AS gap, {r6('round(l_tax, 1)')} AS tax FROM lineitem""")
def _(lake: Lake) -> DataFrame:
    return lake.table("lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_partkey", "l_suppkey", six(F.log1p("l_extendedprice")).alias("log1p"),
        six(F.log2("l_quantity")).alias("log2"), six(F.abs(F.col("l_discount") - 0.05)).alias("gap"), six(F.round("l_tax", 1)).alias("tax"),
    )


@query("k07_safe_divide", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r6('COALESCE(l_quantity / NULLIF(l_tax, 0), 0)')} AS q FROM lineitem")
def _(lake: Lake) -> DataFrame:
    return lake.table("lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_partkey", "l_suppkey", six(ratio(F.col("l_quantity"), F.col("l_tax"), 0.0)).alias("q")
    )


@query("k09_nested_json", f"""WITH {IMP}, t AS (SELECT userid, adgroup_id, count(*) AS n, row_number() OVER (PARTITION BY userid ORDER BY count(*) DESC, adgroup_id) AS rn FROM imp GROUP BY 1, 2)
       SELECT userid, '[' || string_agg('{{"adgroup_id":' || adgroup_id || ',"n":' || n || '}}', ',' ORDER BY rn) || ']' AS doc FROM t WHERE rn <= 5 GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    counts = lake.imp.groupBy("userid", "adgroup_id").agg(N().alias("n"))
    top = top_per_group(counts, "userid", [F.desc("n"), F.col("adgroup_id")], 5)
    packed = F.sort_array(F.collect_list(F.struct("rn", "adgroup_id", "n")))
    return top.groupBy("userid").agg(F.to_json(F.transform(packed, lambda x: F.struct(x["adgroup_id"].alias("adgroup_id"), x["n"].alias("n")))).alias("doc"))


@query("k10_json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(lake: Lake) -> DataFrame:
    return lake.table("events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
