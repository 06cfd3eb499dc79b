"""Catalog snapshots and the candidates each query is scored against.

A query meets every ad of the catalog, which is every ad of the train log. The catalog is cut into
blocks of a bounded number of ads, one array each; a query meets the blocks one by one, and per
block only the number of ads ahead or the best few are kept. Queries are dealt into groups and the
blocks are copied to every group, so what is shuffled is each query once and the catalog once per
group, not a row per query and block. An ad carries its shares by slot, age and segment, a user the
affinities to what the user saw, a last click what was clicked next. Affinities are looked up once
per distinct category and brand of a block and then read by position: every cross feature is a
look-up inside the row. Blocks know the range of what their ads add to a score (``Stats``); where that
range decides, a block is skipped without looking into it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.constants import AD_DYNAMIC, AD_STATIC, CATEGORY_DYNAMIC, SMOOTHING, USER_CONTEXT
from clickloom.functions.scalar import smoothed
from clickloom.operators.coclick import PREV, coclick_snapshot
from clickloom.operators.encode import is_train
from clickloom.operators.joins import lookup
from clickloom.operators.prefix import Timeline, even_numbers, pieces_of, row_position
from clickloom.session import materialize

BLOCK_ADS = 1024    # about as many ads in a block of the catalog
LATEST = ("time_stamp", "event_id")


def last_state(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The last row of each key, as an aggregate that is partial before the shuffle."""
    kept = df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*LATEST)).alias("_last"))
    return kept.select(key, "_last.*")


def product_snapshot(gold: DataFrame) -> DataFrame:
    """State of each ad at the end of train."""
    train = gold.where(is_train())
    return last_state(train, "adgroup_id_key", AD_STATIC + AD_DYNAMIC).withColumnRenamed("adgroup_id_key", "adgroup_id")


def category_snapshot(gold: DataFrame) -> DataFrame:
    return last_state(gold.where(is_train()), "cate_id", CATEGORY_DYNAMIC)


def catalog_of(gold: DataFrame) -> DataFrame:
    """Every train ad with its ad and category state.

    For the most frequent ads only, restrict the log first (``clean.restrict_to_frequent``).
    """
    return product_snapshot(gold).join(category_snapshot(gold), "cate_id", "left")


def first_seen_catalog(star: DataFrame) -> DataFrame:
    """One row per ad over all rows: the attributes it first appeared with."""
    kept = star.groupBy("adgroup_id").agg(F.min_by(F.struct("cate_id", "price"), F.struct(*LATEST)).alias("_first"))
    return kept.select("adgroup_id", "_first.*")


def click_queries(gold: DataFrame) -> DataFrame:
    """Test clicks; each asks where the clicked ad lands in the catalog."""
    return gold.where(~is_train() & (F.col("click") == 1)).select(
        F.col("event_id").alias("query_id"), F.col("adgroup_id_key").alias("true_adgroup_id"),
        F.col("userid_key").alias("userid"), *USER_CONTEXT,
    )


def numbered_queries(gold: DataFrame) -> DataFrame:
    """The same with ids 0..n-1 in time order."""
    clicks = gold.where(~is_train() & (F.col("click") == 1)).withColumn("_us", F.unix_micros("time_stamp"))
    return row_position(clicks, ("_us", "event_id"), Timeline.of(clicks), "query_id").drop("_us")


def user_snapshot(gold: DataFrame, users: DataFrame, train_only: bool = True) -> DataFrame:
    """The last state of the given users, at the end of train or over all rows."""
    rows = gold.where(is_train()) if train_only else gold
    kept = rows.join(users.select(F.col("userid").alias("userid_key")), "userid_key", "left_semi")
    return last_state(kept, "userid_key", USER_CONTEXT).withColumnRenamed("userid_key", "userid")


def frozen_affinity(gold: DataFrame, key: str, name: str, prior: Column) -> DataFrame:
    """Smoothed click rate of each (user, key) at the end of train."""
    sums = gold.where(is_train()).groupBy(F.col("userid_key").alias("userid"), key).agg(
        F.sum("click").alias("_c"), F.count("click").alias("_n")
    )
    return sums.select("userid", key, smoothed(F.col("_c"), F.col("_n"), prior, SMOOTHING).alias(name))


def frozen_prices(gold: DataFrame) -> DataFrame:
    """Mean clicked price per user at the end of train."""
    clicked = gold.where(is_train() & (F.col("click") == 1))
    return clicked.groupBy(F.col("userid_key").alias("userid")).agg(F.avg("price").alias("user_avg_clicked_price"))


def _as_map(key: str, value: str) -> Column:
    return F.map_from_entries(F.collect_list(F.struct(key, value)))


SHARES = {"_pid": ("cate_id", "pid"), "_age": ("cate_id", "age_level"), "_cms": ("brand", "cms_group_id")}


def share_maps(train: DataFrame) -> DataFrame:
    """(kind, key, shares): share of the train rows that each context has with a category or brand."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(a).alias("key"), F.col(c).alias("context")) for k, (a, c) in SHARES.items()])
    counts = train.select(F.explode(pairs).alias("_p")).select("_p.*").groupBy("kind", "key", "context").agg(F.count(F.lit(1)).alias("_n"))
    total = train.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("_v", F.col("_n") / total).groupBy("kind", "key").agg(_as_map("context", "_v").alias("shares"))


def user_maps(train: DataFrame, prior: Column) -> DataFrame:
    """One row per user: affinity by category and by brand, and the mean clicked price, in one pass."""
    kinds = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in ("cate_id", "brand")
    ], F.struct(F.lit("price").alias("kind"), F.lit("").alias("key")))
    rows = train.select(F.col("userid_key").alias("userid"), F.explode(kinds).alias("_k"), "click", "price").select("userid", "_k.*", "click", "price")
    sums = rows.groupBy("userid", "kind", "key").agg(
        smoothed(F.sum("click"), F.count("click"), prior, SMOOTHING).alias("_v"), F.avg(F.when(F.col("click") == 1, F.col("price"))).alias("_price"),
    )
    of = lambda kind: F.map_from_entries(F.collect_list(F.when(F.col("kind") == kind, F.struct("key", "_v"))))
    span = lambda kind: F.struct(*[f(F.when(F.col("kind") == kind, F.col("_v"))).alias(n) for n, f in (("low", F.min), ("up", F.max))])
    return sums.groupBy("userid").agg(
        of("cate_id").alias("_user_cate"), of("brand").alias("_user_brand"), span("cate_id").alias("_cate_span"), span("brand").alias("_brand_span"),
        F.max(F.when(F.col("kind") == "price", F.col("_price"))).alias("user_avg_clicked_price"),
    )


@dataclass(frozen=True)
class Lookups:
    """What candidates are built from, each a written table.

    ``blocks`` (block, ads, their distinct categories and brands, stats, _prior, _mean_price), ``users``
    (userid, maps) and ``follow`` (last clicked ad, per block the shares of the ads that were clicked next).
    """

    blocks: DataFrame
    users: DataFrame
    follow: DataFrame
    n_blocks: int


def lookups_of(gold: DataFrame, catalog: DataFrame, block_ads: int = BLOCK_ADS) -> Lookups:
    train = gold.where(is_train())
    prior, mean_price, n_ads = train.agg(F.avg("click"), F.avg("price")).first() + (catalog.count(),)
    n_blocks = max(1, -(-n_ads // block_ads))
    block = lambda ad: F.pmod(F.xxhash64(ad), F.lit(n_blocks)).cast("int").alias("block")

    shares = materialize(share_maps(train), "shares")
    ads = catalog
    for kind, (key, _) in SHARES.items():
        own = shares.where(F.col("kind") == kind).select(F.col("key").alias(key), F.col("shares").alias(kind))
        ads = ads.join(own, key, "left")
    fields = ["adgroup_id", *[c for c in ads.columns if c != "adgroup_id"]]
    known = F.col("ag_ctr_before").isNotNull()
    stats = F.struct(
        F.count("*").alias("n"), F.count_if(known).alias("n_ctr"), F.count_if(known & F.col("price").isNotNull()).alias("n_scored"),
        F.min("ag_ctr_before").alias("ctr_low"), F.max("ag_ctr_before").alias("ctr_up"), F.min("price").alias("price_low"), F.max("price").alias("price_up"),
        F.coalesce(F.max(F.array_max(F.map_values("_pid"))), F.lit(0.0)).alias("pid_up"),
    )
    blocks = ads.groupBy(block("adgroup_id")).agg(
        F.collect_list(F.struct(*fields)).alias("ads"), F.collect_set("cate_id").alias("_cates"), F.collect_set("brand").alias("_brands"), stats.alias("stats"),
    )
    at = lambda values, ad, c: (F.array_position(values, ad[c]) - 1).cast("int")
    numbered = F.transform("ads", lambda ad: F.struct(*[ad[c].alias(c) for c in fields], at(F.col("_cates"), ad, "cate_id").alias("_ci"), at(F.col("_brands"), ad, "brand").alias("_bi")))
    blocks = blocks.withColumn("ads", numbered).withColumns({"_prior": F.lit(prior).cast("double"), "_mean_price": F.lit(mean_price).cast("double")})
    pairs = coclick_snapshot(gold, "adgroup_id_key").withColumn("_v", F.col("cnt") / F.col("total"))
    follow = pairs.groupBy("prev_item", block("item")).agg(_as_map("item", "_v").alias("_coclick"))
    follow = follow.groupBy(F.col("prev_item").alias(PREV)).agg(_as_map("block", "_coclick").alias("_follow"))
    return Lookups(
        materialize(blocks, "catalog-blocks"), materialize(user_maps(train, F.lit(prior).cast("double")), "user-maps"),
        materialize(follow, "co-clicks"), n_blocks,
    )


def cross_features(ad: Column, affinity: Column) -> dict[str, Column]:
    """Features that depend on both the query and the candidate ad; ``affinity`` has the user's by distinct category and brand."""
    def found(table: Column, key: Column | str, default: Column) -> Column:
        return F.coalesce(F.try_element_at(table, F.col(key) if isinstance(key, str) else key), default)

    zero, prior = F.lit(0.0), F.col("_prior")
    return {
        "pid_x_cate_id_freq": found(ad["_pid"], "pid", zero),
        "cate_id_x_age_level_freq": found(ad["_age"], "age_level", zero),
        "brand_x_cms_group_id_freq": found(ad["_cms"], "cms_group_id", zero),
        "item_coclick_affinity": found(F.col("_coclick"), ad["adgroup_id"], zero),
        "user_cate_affinity_before": F.coalesce(F.get(affinity["c"], ad["_ci"]), prior),
        "user_brand_affinity_before": F.coalesce(F.get(affinity["b"], ad["_bi"]), prior),
        "user_price_gap": ad["price"] - F.coalesce(F.col("user_avg_clicked_price"), F.col("_mean_price")),
    }


Bounds = Callable[[], tuple[Column, Column, str]]    # the least and largest score in a block, and the count of ads that have one
Skip = Callable[[Column, Column], Column]            # from these two: whether the block needs no look
MARGIN = 1e-9                                        # sums in another order differ by less

AD_HELPERS = [*SHARES, "_ci", "_bi"]
HELPERS = [
    "_user_cate", "_user_brand", "_cate_span", "_brand_span", "_coclick", "_follow", "_prior", "_mean_price", "user_avg_clicked_price", "_cates", "_brands", "ads",
]


def every_block(queries: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each query with each block: the blocks are copied to as many groups of queries as a shuffle has partitions.

    Every group is a task. The number is given, since adaptive execution goes by the size of the queries and would put them into
    one task, whatever number of blocks each of them meets.
    """
    groups = pieces_of(queries)
    flat = [c for c, kind in queries.dtypes if not kind.startswith(("array", "map", "struct"))]
    numbers = F.lit(even_numbers(queries.sparkSession, groups, groups))
    copies = blocks.withColumn("_group", F.explode(numbers)).repartition(groups, "_group")
    dealt = queries.withColumn("_group", F.get(numbers, F.pmod(F.xxhash64(*flat), F.lit(groups)).cast("int"))).repartition(groups, "_group")
    return dealt.join(copies, "_group").drop("_group")


def single_ads(blocks: DataFrame) -> DataFrame:
    """The blocks with one ad each, by that ad as ``true_adgroup_id``: who asks for one ad does not carry its neighbours."""
    fields = blocks.schema["ads"].dataType.elementType.fieldNames()
    one = F.struct(*[F.lit(0).alias(c) if c in ("_ci", "_bi") else F.col("_ad")[c].alias(c) for c in fields])
    kept = [c for c in blocks.columns if c not in ("ads", "_cates", "_brands")]
    return blocks.select(*kept, F.explode("ads").alias("_ad")).select(
        *kept, F.col("_ad.adgroup_id").alias("true_adgroup_id"), F.array(one).alias("ads"),
        F.array("_ad.cate_id").alias("_cates"), F.array("_ad.brand").alias("_brands"),
    )


def meeting(queries: DataFrame, lookups: Lookups, only: Column | None = None, own_ad_only: bool = False) -> DataFrame:
    """A row per query and block with all that candidates are made of; ``only`` names one block per query, ``own_ad_only`` leaves its own ad."""
    out = lookup(lookup(queries, lookups.users, ["userid"]), lookups.follow, [PREV])
    if own_ad_only:
        out = out.join(single_ads(lookups.blocks), "true_adgroup_id")
    else:
        out = every_block(out, lookups.blocks) if only is None else out.withColumn("block", only).join(lookups.blocks, "block")
    return out.withColumn("_coclick", F.try_element_at("_follow", "block"))


def with_candidates(
    queries: DataFrame, lookups: Lookups, own_ad_only: bool = False, only: Column | None = None, bounds: Bounds | None = None, skip: Skip | None = None,
) -> DataFrame:
    """A row per query and ``block`` with ``candidates``: the block's ads with state and cross features.

    ``own_ad_only`` keeps just the query's own ad, and no row where the catalog lacks it; ``only`` the block it names. With
    ``bounds``, rows have ``_low`` and ``_up``, and candidates are null where ``skip`` says so.
    """
    out, looked = meeting(queries, lookups, only, own_ad_only), F.col("ads")
    if bounds:
        low, up, _ = bounds()
        out = out.withColumns({"_low": low - MARGIN, "_up": up + MARGIN})
        looked = F.when(~F.coalesce(skip(F.col("_low"), F.col("_up")), F.lit(False)), looked)
    first = [c for c in lookups.blocks.schema["ads"].dataType.elementType.fieldNames() if c not in AD_HELPERS]
    of = lambda values, table: F.transform(values, lambda v: F.try_element_at(table, v))
    affinity = F.array(F.struct(of("_cates", F.col("_user_cate")).alias("c"), of("_brands", F.col("_user_brand")).alias("b")))

    def candidate(ad: Column, own: Column) -> Column:
        return F.struct(*[ad[c].alias(c) for c in first], *[c.alias(n) for n, c in cross_features(ad, own).items()])

    # The outer transform has one element: it names the affinities, so that they are looked up once per block.
    made = F.get(F.transform(affinity, lambda own: F.transform(looked, lambda ad: candidate(ad, own))), 0)
    return out.withColumn("candidates", made).drop(*HELPERS)


def exploded(with_arrays: DataFrame) -> DataFrame:
    """One row per query and candidate, for models that score rows."""
    keep = [c for c in with_arrays.columns if c not in ("candidates", "block", "stats")]
    return with_arrays.select(*keep, F.explode("candidates").alias("_c")).select(*keep, "_c.*")


Score = Callable[[Column], Column]


def with_scores(df: DataFrame, score: Score) -> DataFrame:
    """Replace the candidates by (score, adgroup_id) pairs."""
    pairs = F.transform("candidates", lambda c: F.struct(score(c).alias("score"), c["adgroup_id"].alias("adgroup_id")))
    return df.withColumn("scored", pairs).drop("candidates")


def linear_score(c: Column) -> Column:
    """A fixed scoring rule, for runs without a model."""
    return (
        c["ag_ctr_before"] + c["user_cate_affinity_before"] * 0.5 + c["user_brand_affinity_before"] * 0.5
        + c["item_coclick_affinity"] * 0.25 + c["pid_x_cate_id_freq"] - c["user_price_gap"] * 0.0001
    )


def popularity_score(c: Column) -> Column:
    return c["ag_ctr_before"]


def linear_bounds() -> tuple[Column, Column, str]:
    prior, stats = F.col("_prior"), F.col("stats")
    own = F.coalesce(F.col("user_avg_clicked_price"), F.col("_mean_price"))
    ends = lambda pick, end: (pick(prior, F.col(f"_cate_span.{end}")) + pick(prior, F.col(f"_brand_span.{end}"))) * 0.5
    next_up = F.coalesce(F.array_max(F.map_values("_coclick")), F.lit(0.0)) * 0.25
    low = stats["ctr_low"] + ends(F.least, "low") - (stats["price_up"] - own) * 0.0001
    up = stats["ctr_up"] + ends(F.greatest, "up") + next_up + stats["pid_up"] - (stats["price_low"] - own) * 0.0001
    return low, up, "n_scored"


def popularity_bounds() -> tuple[Column, Column, str]:
    return F.col("stats.ctr_low"), F.col("stats.ctr_up"), "n_ctr"


# Scores whose range in a block is known; others look into every block.
BOUNDS: dict[Score, Bounds] = {linear_score: linear_bounds, popularity_score: popularity_bounds}
