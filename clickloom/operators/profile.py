"""Volume, click-rate and concentration profiles of the log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.constants import SEGMENT_COLUMNS, USER_BUCKET_EDGES, USER_BUCKET_LABELS
from clickloom.functions.scalar import ratio
from clickloom.operators.encode import is_train
from clickloom.operators.prefix import by_value, global_rank


def _n() -> Column:
    return F.count(F.lit(1))


def overview(log: DataFrame) -> DataFrame:
    """Each distinct count reads its own column: together in one aggregate they would copy every row once per count."""
    different = {name: log.select(c).distinct().agg(F.count(c)).scalar() for name, c in (("days", "date"), ("users", "userid"), ("ads", "adgroup_id"))}
    return log.agg(
        _n().alias("impressions"),
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        F.count_if(is_train()).alias("train_rows"), F.count_if(~is_train()).alias("test_rows"),
        F.avg("click").alias("ctr"),
    ).withColumns(different).select(
        "impressions", "start_date", "end_date", "days", "users", "ads", "train_rows", "test_rows", "ctr")


def volume_and_ctr(log: DataFrame, key: str) -> DataFrame:
    return log.groupBy(key).agg(_n().alias("impressions"), F.avg("click").alias("ctr"))


def top_by_volume(log: DataFrame, key: str, size: int = 20) -> DataFrame:
    return volume_and_ctr(log, key).orderBy(F.desc("impressions"), key).limit(size)


def value_shares(df: DataFrame, key: str) -> DataFrame:
    """Count of each value and its share of all rows."""
    counts = df.groupBy(key).agg(_n().alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def ads_per_user(log: DataFrame) -> DataFrame:
    return log.groupBy("userid").agg(
        F.countDistinct("adgroup_id").alias("n_ads"), _n().alias("impressions"), F.sum("click").alias("clicks")
    )


def segment_ctr(star: DataFrame, columns: Sequence[str] = SEGMENT_COLUMNS) -> DataFrame:
    """Click rate of every level of every segment column, in one pass."""
    levels = F.array(*[F.struct(F.lit(c).alias("segment"), F.col(c).cast("string").alias("level")) for c in columns])
    return star.select(F.explode(levels).alias("_s"), "click").select("_s.*", "click").groupBy("segment", "level").agg(
        _n().alias("impressions"), F.avg("click").alias("ctr")
    )


def user_stats(log: DataFrame) -> DataFrame:
    stats = log.groupBy("userid").agg(_n().alias("impressions"), F.sum("click").alias("clicks"))
    return stats.withColumn("clicked_at_least_once", F.col("clicks") > 0)


def impression_blocks(stats: DataFrame) -> DataFrame:
    """Users collapsed by their impression count.

    Distinct counts of N impressions cannot exceed sqrt(2 N), so this is small enough for an exact
    percentile in one aggregate.
    """
    return stats.groupBy("impressions").agg(
        _n().alias("users"), F.sum("clicks").alias("clicks"), F.count_if(F.col("clicked_at_least_once")).alias("clickers")
    )


def customer_overview(log: DataFrame, registered: DataFrame) -> DataFrame:
    """Activity of users and what the most active tenth contributes."""
    blocks = impression_blocks(user_stats(log))
    cut = blocks.agg(F.percentile("impressions", 0.9, F.col("users"))).scalar()
    shown = F.col("impressions") * F.col("users")
    top = F.col("impressions") >= F.col("_cut")
    once = F.sum(F.when(F.col("impressions") == 1, F.col("users")).otherwise(0))
    known = registered.agg(F.countDistinct("userid")).scalar()
    users = F.sum("users")
    return blocks.withColumn("_cut", cut).agg(
        users.alias("active_users"),
        (F.sum(shown) / users).alias("mean_impressions"),
        (F.sum("clicks") / users).alias("mean_clicks"),
        (F.sum("clickers") / users).alias("clicker_share"),
        once.alias("seen_once"),
        (once / users).alias("seen_once_share"),
        (F.sum(F.when(top, shown)) / F.sum(shown)).alias("top10_impression_share"),
        (F.sum(F.when(top, F.col("clicks"))) / F.sum("clicks")).alias("top10_click_share"),
    ).withColumn("registered_users", known).withColumn("active_share", F.col("active_users") / F.col("registered_users"))


def active_users(registered: DataFrame, log: DataFrame) -> DataFrame:
    return registered.join(log.select("userid").distinct(), "userid", "left_semi")


def center(df: DataFrame, value: str, weight: str) -> DataFrame:
    """Mean and median of a collapsed column."""
    return df.agg(
        (F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("mean"),
        F.percentile(value, 0.5, F.col(weight)).alias("median"),
    )


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based bin; the largest value belongs to the last bin."""
    step = F.nullif((high - low).cast("double"), F.lit(0.0))
    return F.coalesce(F.least(F.floor((value - low) / step * bins), F.lit(bins - 1)), F.lit(0)).cast("bigint") + 1


def histogram(df: DataFrame, value: str, bins: int, weight: str | None = None) -> DataFrame:
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    limits = span.select(F.struct("lo", "hi")).scalar()
    binned = df.withColumn("_s", limits).withColumn("bin", equal_width_bin(F.col(value), F.col("_s.lo"), F.col("_s.hi"), bins))
    n = F.sum(weight) if weight else _n()
    return binned.groupBy("bin").agg(n.alias("n"), F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def impression_curve(stats: DataFrame) -> DataFrame:
    """Users ordered by impressions, as one row per distinct count with everything below it."""
    return by_value(stats, ["impressions"], {"users": F.lit(1), "shown": F.col("impressions")})


def gini(stats: DataFrame) -> DataFrame:
    """Gini coefficient of impressions per user, in closed form per distinct count."""
    curve = impression_curve(stats)
    inside = F.col("users") * F.col("shown_below") + F.col("value") * F.col("users") * (F.col("users") + 1) / 2
    return curve.agg(
        F.max("users_total").alias("users"), F.sum(inside).alias("_cum"), F.max("shown_total").alias("_all")
    ).select("users", ((F.col("users") + 1 - 2 * F.col("_cum") / F.col("_all")) / F.col("users")).alias("gini"))


def lorenz(stats: DataFrame) -> DataFrame:
    """Cumulative share of users and impressions after each distinct impression count."""
    curve = impression_curve(stats)
    return curve.select(
        F.col("value").cast("bigint").alias("impressions"),
        ((F.col("users_below") + F.col("users")) / F.col("users_total")).alias("cum_users"),
        ((F.col("shown_below") + F.col("shown")) / F.col("shown_total")).alias("cum_impressions"),
    )


def top_share(stats: DataFrame, share: float = 0.2) -> DataFrame:
    """Share of impressions that the most shown users receive."""
    above = F.col("users_total") - F.col("users_below") - F.col("users")
    wanted = F.floor(F.col("users_total") * share)
    taken = F.greatest(F.lit(0), F.least(F.col("users"), wanted - above))
    return impression_curve(stats).agg(
        F.max(wanted).alias("users"), (F.sum(taken * F.col("value")) / F.max("shown_total")).alias("share")
    )


def ranked_buckets(stats: DataFrame, by: str) -> DataFrame:
    """Users in descending order of ``by`` (ties by id) with the bucket their rank falls into."""
    ranked = global_rank(stats, by, "userid")
    bucket = F.lit(None).cast("string")
    for edge, label in reversed(list(zip(USER_BUCKET_EDGES[1:], USER_BUCKET_LABELS))):
        bucket = F.when(F.col("rank") < F.floor(F.col("rank_of") * edge), F.lit(label)).otherwise(bucket)
    return ranked.withColumn("bucket", bucket)


def bucket_ctr(stats: DataFrame, by: str = "impressions", mean_of: str | None = None) -> DataFrame:
    """Users, impressions, clicks and click rate per bucket."""
    extra = [F.avg(mean_of).alias(f"mean_{mean_of}")] if mean_of else []
    out = ranked_buckets(stats, by).groupBy("bucket").agg(
        _n().alias("users"), *extra, F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks")
    )
    return out.withColumn("ctr", ratio(F.col("clicks"), F.col("impressions"), 0.0))


def ad_snapshot(gold: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The last known state of each ad."""
    order = F.struct("time_stamp", "event_id")
    return gold.groupBy(F.col("adgroup_id_key").alias("adgroup_id")).agg(
        F.max_by(F.struct(*columns), order).alias("_last")
    ).select("adgroup_id", "_last.*")


def trending(snapshot: DataFrame, size: int = 10) -> DataFrame:
    """The ads that heat up and cool down most."""
    trend = "ag_ctr_trend_1d_vs_3d"
    hot = snapshot.orderBy(F.desc(trend), "adgroup_id").limit(size).withColumn("direction", F.lit("heating"))
    cold = snapshot.orderBy(F.asc(trend), "adgroup_id").limit(size).withColumn("direction", F.lit("cooling"))
    return hot.unionByName(cold)


def leaders(snapshot: DataFrame, by: str, size: int = 15) -> DataFrame:
    return snapshot.orderBy(F.desc(by), "adgroup_id").limit(size)


def leader_overlap(snapshot: DataFrame, size: int = 15) -> DataFrame:
    """Ads among both the most shown and the highest earning."""
    shown = leaders(snapshot, "ag_impressions_before", size).select("adgroup_id")
    earning = leaders(snapshot, "ag_revenue_before", size).select("adgroup_id")
    return shown.intersect(earning)


def ctr_range(log: DataFrame, support: int = 200) -> DataFrame:
    """Lowest and highest click rate among ads with enough impressions."""
    per_ad = volume_and_ctr(log, "adgroup_id").where(F.col("impressions") >= support)
    return per_ad.agg(_n().alias("ads"), F.min("ctr").alias("min_ctr"), F.max("ctr").alias("max_ctr"))


def price_deciles(star: DataFrame) -> DataFrame:
    """Click rate by tenths of the impressions in price order; equal prices stay together."""
    prices = by_value(star, ["price"], {"n": F.lit(1), "clicks": F.col("click")})
    decile = F.floor(F.col("n_below") * 10 / F.col("n_total")).cast("bigint") + 1
    return prices.groupBy(decile.alias("decile")).agg(
        _n().alias("price_levels"), F.sum("n").alias("impressions"), (F.sum("clicks") / F.sum("n")).alias("ctr")
    )


def relabeling(star: DataFrame, columns: Sequence[str], target: str = "adgroup_id") -> DataFrame:
    """Share of the values of each column that belong to exactly one ad."""
    pairs = star.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("_p"),
        target,
    ).select("_p.*", target).distinct()
    per_value = pairs.groupBy("column", "value").agg(_n().alias("ads"))
    return per_value.groupBy("column").agg(
        _n().alias("values"), F.count_if(F.col("ads") == 1).alias("single"), F.avg((F.col("ads") == 1).cast("int")).alias("share")
    )


def mix_shift(log: DataFrame, key: str = "adgroup_id") -> DataFrame:
    """Total variation distance between the train and test mix of a key."""
    counts = log.groupBy(key).agg(F.count_if(is_train()).alias("a"), F.count_if(~is_train()).alias("b"))
    totals = counts.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b"))).scalar()
    shares = counts.withColumn("_t", totals)
    gap = F.abs(F.col("a") / F.col("_t.a") - F.col("b") / F.col("_t.b"))
    return shares.agg((F.sum(gap) / 2).alias("tvd"))


def missing_gap(star: DataFrame, columns: Sequence[str], missing: str = "unknown") -> DataFrame:
    """Click rate of rows with and without a value in each column."""
    marks = F.array(*[F.struct(F.lit(c).alias("column"), (F.col(c) == missing).alias("is_missing")) for c in columns])
    rows = star.select(F.explode(marks).alias("_m"), "click").select("_m.*", "click")
    gone = F.when(F.col("is_missing"), F.col("click"))
    there = F.when(~F.col("is_missing"), F.col("click"))
    return rows.groupBy("column").agg(
        F.count(gone).alias("missing_rows"), F.avg(gone).alias("missing_ctr"), F.avg(there).alias("present_ctr")
    ).withColumn("gap", F.col("missing_ctr") - F.col("present_ctr"))


def coverage(catalog: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """How much of a catalog was ever seen in the log."""
    seen = log.select(F.col(key).alias("_seen")).distinct()
    joined = catalog.select(key).distinct().join(seen, F.col(key) == F.col("_seen"), "left")
    return joined.agg(
        _n().alias("catalog"), F.count("_seen").alias("seen"), (F.count("_seen") / _n()).alias("share")
    )


def never_seen(catalog: DataFrame, log: DataFrame, key: str) -> DataFrame:
    return catalog.select(key).distinct().join(log.select(key).distinct(), key, "left_anti")


def daily_spread(log: DataFrame) -> DataFrame:
    daily = volume_and_ctr(log, "date")
    return daily.agg(
        _n().alias("days"), F.min("ctr").alias("min_ctr"), F.max("ctr").alias("max_ctr"), F.stddev_samp("ctr").alias("std_ctr")
    )
