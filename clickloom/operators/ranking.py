"""Ranks, recall, lift and recommendations from scored candidates and scored rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clickloom.constants import LIFT_PERCENTS, RECALL_KS, SEED
from clickloom.functions.scalar import hash32, ratio
from clickloom.operators.candidates import BOUNDS, Lookups, Score, meeting, with_candidates, with_scores
from clickloom.operators.prefix import by_value, global_rank, pieces_of
from clickloom.operators.profile import ranked_buckets, user_stats
from clickloom.session import materialize


def own_score(score: Column, ad: Column) -> Column:
    """Highest score among rows or elements of the query's own ad."""
    return F.max(F.when(ad == F.col("true_adgroup_id"), score))


def block_counts(queries: DataFrame, lookups: Lookups, score: Score) -> DataFrame:
    """Per (query, block) how many ads of the block are ahead of the query's own score ``_mine``; blocks whose range of scores
    decides that are not looked into."""
    bounds, mine = BOUNDS.get(score), F.col("_mine")
    skip = lambda low, up: mine.isNull() | (up < mine) | (low > mine)
    scored = with_scores(with_candidates(queries, lookups, bounds=bounds, skip=skip), score)
    ahead = F.size(F.filter("scored", lambda x: (x["score"] > mine) | ((x["score"] == mine) & (x["adgroup_id"] < F.col("true_adgroup_id")))))
    if bounds:
        ahead = F.when(mine.isNull() | (F.col("_up") < mine), 0).when(F.col("_low") > mine, F.col(f"stats.{bounds()[2]}")).otherwise(ahead)
    return scored.select("query_id", "true_adgroup_id", "_mine", ahead.alias("_ahead"), F.col("stats.n").alias("_size"))


def summed_ranks(counts: DataFrame) -> DataFrame:
    sums = counts.groupBy("query_id").agg(
        F.first("true_adgroup_id").alias("true_adgroup_id"), F.first("_mine").alias("_mine"),
        F.sum("_ahead").alias("_ahead"), F.sum("_size").alias("catalog_size"),
    )
    rank = F.when(F.col("_mine").isNull(), F.col("catalog_size")).otherwise(F.col("_ahead"))
    return sums.select("query_id", "true_adgroup_id", rank.alias("rank"), "catalog_size")


def true_ranks(queries: DataFrame, lookups: Lookups, score: Score) -> DataFrame:
    """0-based rank of the clicked ad among the candidates of its query.

    Higher score first, then smaller ad id; the catalog size if the ad is not a candidate. The
    query's own score is made for that ad alone, the ads ahead of it are counted block by block.
    """
    own = with_scores(with_candidates(queries, lookups, own_ad_only=True), score)
    mine = F.try_element_at(F.filter("scored", lambda x: x["adgroup_id"] == F.col("true_adgroup_id")), F.lit(1))["score"]
    known = own.select("query_id", mine.alias("_mine")).where(F.col("_mine").isNotNull())
    asked = queries.join(known, "query_id", "left")
    return summed_ranks(block_counts(asked, lookups, score))


def best_scored(queries: DataFrame, lookups: Lookups, score: Score, key: str = "userid", size: int = 100) -> DataFrame:
    """(key, scored) of the blocks that may hold one of the ``size`` best ads of a key, for ``recommendations``.

    The block with the highest bound is looked into first. If it holds so many ads, the last of its best is a
    score that every other block has to reach with its bound. A single block is looked into once.
    """
    bounds = BOUNDS.get(score)
    if bounds is None or lookups.n_blocks == 1:
        return with_scores(with_candidates(queries, lookups), score).select(key, "scored")
    met = meeting(queries, lookups).withColumn("_up", bounds()[1]).groupBy(key).agg(F.max_by("block", F.struct("_up", "block")).alias("_first"))
    asked = materialize(queries.join(met, key).repartition(pieces_of(queries), key), "first-blocks")
    best = with_scores(with_candidates(asked, lookups, only=F.col("_first")), score)
    ordered = F.array_sort(F.filter(F.transform("scored", lambda x: -x["score"]), lambda x: x.isNotNull()))
    floor = best.select(F.col(key).alias("_key"), (-F.try_element_at(ordered, F.lit(size))).alias("_floor"))
    asked = asked.join(floor, asked[key] == floor["_key"], "left").drop("_key", "_first")
    rows = with_candidates(asked, lookups, bounds=bounds, skip=lambda low, up: up < F.col("_floor"))
    return with_scores(rows.where("candidates IS NOT NULL"), score).select(key, "scored")


def true_ranks_of_rows(scored_rows: DataFrame) -> DataFrame:
    """The same for candidates that a model scored row by row (query_id, true_adgroup_id, adgroup_id, score)."""
    known = scored_rows.groupBy("query_id").agg(own_score(F.col("score"), F.col("adgroup_id")).alias("_mine"))
    ahead = (F.col("score") > F.col("_mine")) | ((F.col("score") == F.col("_mine")) & (F.col("adgroup_id") < F.col("true_adgroup_id")))
    rows = scored_rows.join(known, "query_id")
    return summed_ranks(rows.select("query_id", "true_adgroup_id", "_mine", F.coalesce(ahead, F.lit(False)).cast("int").alias("_ahead"), F.lit(1).alias("_size")))


def recall_at(ranks: DataFrame, ks: Sequence[int] = RECALL_KS) -> DataFrame:
    """Share of queries whose clicked ad is among the first K, one row."""
    return ranks.agg(
        F.count(F.lit(1)).alias("queries"), *[F.avg((F.col("rank") < k).cast("int")).alias(f"recall_at_{k}") for k in ks]
    )


def precision_at(ranks: DataFrame, ks: Sequence[int] = (10, 50, 100)) -> DataFrame:
    """Precision and recall at K against their random floors, one row per K."""
    sums = ranks.agg(
        F.count(F.lit(1)).alias("n"), F.max("catalog_size").alias("size"),
        F.array(*[F.struct(F.lit(k).cast("bigint").alias("k"), F.count_if(F.col("rank") < k).alias("hits")) for k in ks]).alias("_k"),
    )
    k, hits, n, size = F.col("_e.k"), F.col("_e.hits"), F.col("n"), F.col("size")
    precision = ratio(hits, n * k)
    return sums.select("n", "size", F.explode("_k").alias("_e")).select(
        k.alias("k"), precision.alias("precision"), ratio(hits, n).alias("recall"),
        ratio(F.lit(1), size).alias("random_precision"), ratio(k, size).alias("random_recall"),
        (precision * size).alias("precision_lift"),
    )


def recommendations(scored: DataFrame, key: str = "userid", size: int = 100, cheapest_first: bool = False) -> DataFrame:
    """The best ``size`` candidates per key, best first, scores rounded to six decimals.

    Every block of candidates is cut to its best before the blocks of a key meet.
    """
    pick = lambda x: F.struct((-x["score"]).alias("minus"), x["adgroup_id"].alias("adgroup_id"), x["score"].alias("score"))
    if cheapest_first:
        pick = lambda x: F.struct(
            (-x["score"]).alias("minus"), x["price"].alias("price"), x["adgroup_id"].alias("adgroup_id"), x["score"].alias("score")
        )
    best = F.slice(F.sort_array(F.transform("scored", pick)), 1, size)
    merged = scored.select(key, best.alias("_best")).groupBy(key).agg(F.sort_array(F.flatten(F.collect_list("_best"))).alias("_best"))
    shaped = F.transform(F.slice("_best", 1, size), lambda x: F.struct(x["adgroup_id"].alias("adgroup_id"), F.round(x["score"], 6).alias("score")))
    return merged.select(key, shaped.alias("recommendations"))


def recommendations_of_rows(scored_rows: DataFrame, key: str = "userid", size: int = 100) -> DataFrame:
    """The same for candidates scored row by row (key, adgroup_id, score)."""
    best = top_per_group(scored_rows.select(key, "adgroup_id", "score"), key, [F.desc("score"), F.col("adgroup_id")], size)
    packed = best.groupBy(key).agg(F.collect_list(F.struct("score", "adgroup_id")).alias("scored"))
    return recommendations(packed, key, size)


def write_recommendations(recs: DataFrame, path: str) -> None:
    """One JSON object per key with its list of recommendations."""
    recs.write.mode("overwrite").json(path)


def exploded_recommendations(recs: DataFrame, key: str = "userid") -> DataFrame:
    return recs.select(key, F.posexplode("recommendations").alias("pos", "_r")).select(
        key, F.col("pos").cast("bigint").alias("position"), "_r.adgroup_id", "_r.score"
    )


def sampled_users(users: DataFrame, size: int = 100, seed: int = SEED) -> DataFrame:
    """A reproducible sample: the users with the smallest seeded hash."""
    return users.select("userid").distinct().orderBy(
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("userid").cast("string"))), "userid"
    ).limit(size)


def random_score(seed: int = SEED, query: str = "query_id"):
    """A reproducible uniform score per query and candidate."""
    def score(c: Column) -> Column:
        return hash32(str(seed), F.col(query).cast("string"), c["adgroup_id"].cast("string")) / F.lit(4294967296.0)
    return score


def _area(values: DataFrame) -> DataFrame:
    pos = F.col("pos").cast("double")
    neg, neg_below = F.col("n") - F.col("pos"), F.col("n_below") - F.col("pos_below")
    return values.groupBy("feature").agg(
        F.sum(pos * (neg_below + neg / 2)).alias("_u"), F.max("pos_total").cast("double").alias("_p"),
        F.max("n_total").cast("double").alias("_n"),
    ).select("feature", ratio(F.col("_u"), F.col("_p") * (F.col("_n") - F.col("_p"))).alias("auc"))


def auc_of(df: DataFrame, scores: Sequence[str], label: str = "click") -> DataFrame:
    """Area under the ROC curve per score column, as (feature, auc).

    P(score of a click > score of another row), ties one half; all columns in one pass.
    """
    return _area(by_value(df, scores, {"pos": F.col(label), "n": F.lit(1)}))


def auc(df: DataFrame, score: str, label: str = "click") -> DataFrame:
    return auc_of(df, [score], label).select("auc")


PACKED = "feature bigint, part int, clicks binary, others binary"


def packed_scores(feature: int, scores: np.ndarray, click: np.ndarray, borders: np.ndarray) -> pa.RecordBatch:
    """The scores of some rows of a group as bytes: a row per part that the inner ``borders`` leave between them."""
    part = np.searchsorted(borders, scores, side="right")
    found = [(int(p), part == p) for p in np.unique(part)]
    clicks, others = ([scores[here & own].tobytes() for _, here in found] for own in (click, ~click))
    return pa.record_batch([
        pa.array([feature] * len(found), pa.int64()), pa.array([p for p, _ in found], pa.int32()), pa.array(clicks, pa.binary()), pa.array(others, pa.binary()),
    ], names=["feature", "part", "clicks", "others"])


def auc_by_group(packed: DataFrame) -> DataFrame:
    """The area of every group of packed scores, as (feature, auc).

    Pairs within a part are counted in its task, on sorted arrays; the clicks of a part are ahead of all others in the parts below.
    """
    def count(table: pa.Table) -> pa.Table:
        click, other = (np.sort(np.concatenate([np.zeros(0), *[np.frombuffer(b.as_buffer()) for b in table.column(c)]])) for c in ("clicks", "others"))
        u = float(np.searchsorted(other, click, "left").sum() + np.searchsorted(other, click, "right").sum()) / 2
        return pa.table({"feature": table.column("feature")[:1], "part": table.column("part")[:1], "u": [u], "clicks": [len(click)], "others": [len(other)]})

    sums = packed.groupBy("feature", "part").applyInArrow(count, "feature bigint, part int, u double, clicks bigint, others bigint")
    below = F.coalesce(F.sum("others").over(W.partitionBy("feature").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    whole = sums.withColumn("_u", F.col("u") + F.col("clicks").cast("double") * below)
    return whole.groupBy("feature").agg(ratio(F.sum("_u"), F.sum("clicks").cast("double") * F.sum("others")).alias("auc"))


def log_loss(df: DataFrame, probability: str, label: str = "click", clip: float = 1e-15) -> DataFrame:
    p = F.greatest(F.lit(clip), F.least(F.lit(1.0 - clip), F.col(probability)))
    return df.agg(F.avg(-F.ln(F.when(F.col(label) == 1, p).otherwise(1 - p))).alias("log_loss"))


def lift_table(df: DataFrame, score: str, label: str = "click", percents: Sequence[int] = LIFT_PERCENTS) -> DataFrame:
    """Click rate among the best scored share of rows, against the overall rate."""
    ranked = global_rank(df.select("event_id", score, label), score, "event_id")
    wanted = lambda p: F.greatest(F.lit(1), F.floor(F.col("rank_of") * p / 100)).cast("bigint")
    sums = ranked.agg(
        F.avg(label).alias("_all"),
        F.array(*[
            F.struct(
                F.lit(p).cast("bigint").alias("top_percent"), F.max(wanted(p)).alias("n_impressions"),
                F.sum(F.when(F.col("rank") < wanted(p), F.col(label))).alias("_clicks"),
            ) for p in percents
        ]).alias("_rows"),
    )
    rows = sums.select("_all", F.explode("_rows").alias("_r")).select("_all", "_r.*")
    rate = ratio(F.col("_clicks"), F.col("n_impressions"))
    return rows.select("top_percent", "n_impressions", rate.alias("ctr"), ratio(rate, F.col("_all")).alias("lift"))


def recalibrated(p: Column, sampled_rate: float, real_rate: float) -> Column:
    """Probability learned on over-sampled clicks, moved to the real click rate."""
    weight = (sampled_rate / (1 - sampled_rate)) / (real_rate / (1 - real_rate))
    return p / (p + (1 - p) * weight)


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], size: int) -> DataFrame:
    """The first rows of each group; Spark cuts groups down before the shuffle."""
    rank = F.row_number().over(W.partitionBy(group).orderBy(*order))
    return df.withColumn("rn", rank).where(F.col("rn") <= size)


def frequency_capped(log: DataFrame, served: DataFrame, cap: int, share_label: str = "Top 0-5%") -> DataFrame:
    """Keep at most ``cap`` servings, best score first, of the users shown most; others keep all."""
    heavy = ranked_buckets(user_stats(log), "impressions").where(F.col("bucket") == share_label).select("userid")
    marked = served.join(heavy.withColumn("_heavy", F.lit(True)), "userid", "left")
    capped = top_per_group(marked.where(F.col("_heavy")), "userid", [F.desc("score"), F.col("adgroup_id")], cap).drop("rn")
    return marked.where(F.col("_heavy").isNull()).unionByName(capped).drop("_heavy")
