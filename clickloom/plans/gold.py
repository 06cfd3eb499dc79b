"""The Gold table: every impression with its 40 point-in-time features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.constants import CATEGORICAL_FEATURES, GOLD_COLUMNS, ID_COLUMNS, INTERACTIONS
from clickloom.functions.scalar import category_text, fold_of, micros
from clickloom.operators.coclick import with_coclick_affinity, with_previous_click
from clickloom.operators.encode import encoded, fold_sums, frequency_encode, target_mean, train_mean
from clickloom.operators.history import LOOK_BACKS, affinity_history, click_history, ctr_trend, user_history, windowed_history
from clickloom.operators.joins import lookup
from clickloom.operators.prefix import ROWS_PER_CHAIN, Timeline, by_chunk
from clickloom.session import materialize


def ad_table(per_ad: DataFrame, dim_ad: DataFrame) -> DataFrame:
    """Ad attributes with the encoding sums of the ad, its campaign and its customer.

    Campaigns and customers are rolled up from the sums per ad; the log is not read again.
    """
    table = dim_ad.join(per_ad, "adgroup_id", "full")
    out = table
    for key in ("campaign_id", "customer"):
        sums = F.col("_adgroup_id_sums")
        rolled = table.where(F.col(key).isNotNull() & sums.isNotNull()).groupBy(key).agg(
            F.struct(
                F.sum(sums["s"]).alias("s"), F.sum(sums["n"]).alias("n"),
                F.array(*[F.sum(sums["fold_s"][i]) for i in range(5)]).alias("fold_s"),
                F.array(*[F.sum(sums["fold_n"][i]) for i in range(5)]).alias("fold_n"),
            ).alias(f"_{key}_sums")
        )
        out = out.join(rolled, key, "left")
    return out


def staged_rows(fact: DataFrame, dim_ad: DataFrame, dim_user: DataFrame) -> DataFrame:
    """The star-joined log with its id encodings, written once.

    The sums per user and per ad are joined to the dimensions, so the log meets each side once.
    """
    prior = target_mean(fact)
    rows = fact if "_us" in fact.columns else fact.withColumn("_us", micros(F.col("time_stamp")))
    sums = fold_sums(fact, ["userid", "adgroup_id"])
    users = dim_user.join(sums["userid"], "userid", "full")
    ads = materialize(ad_table(sums["adgroup_id"], dim_ad), "gold-ads")
    rows = lookup(lookup(rows.withColumn("_fold", fold_of(F.col("event_id"))), users, ["userid"]), ads, ["adgroup_id"])
    rows = rows.withColumns({f"{c}_te": encoded(c, prior, F.col("_fold")) for c in ID_COLUMNS})
    return materialize(rows.drop("_fold", *[f"_{c}_sums" for c in ID_COLUMNS]), "gold-rows")


def gold_features(rows: DataFrame, timeline: Timeline) -> DataFrame:
    """Add all features to staged rows; the whole chain runs on one shuffle by chunk.

    Columns that no window reads travel as one packed column.
    """
    prior = target_mean(rows)
    mean_price = train_mean(rows, "price")
    read = ["_us", "event_id", "userid", "adgroup_id", "cate_id", "brand", "price", "click"]
    rest = [c for c in rows.columns if c not in read]
    base = timeline.chunked(rows.select(*read))

    out = rows.select(*read, F.struct(*rest).alias("_rest"))
    out = windowed_history(out, "adgroup_id", "ag", prior, timeline, revenue="price")
    out = click_history(out, ["cate_id"], "cate", prior, base)
    out = user_history(out, prior, mean_price, base)
    out = affinity_history(out, ["userid", "cate_id"], "user_cate", prior, base)
    out = affinity_history(out, ["userid", "brand"], "user_brand", prior, base)
    out = with_coclick_affinity(out, with_previous_click(by_chunk(base), base))
    out = ctr_trend(out.select("*", "_rest.*").drop("_rest"))
    return frequency_encode(out, INTERACTIONS, base=rows)


def gold_table(fact: DataFrame, dim_ad: DataFrame, dim_user: DataFrame, timeline: Timeline | None = None) -> DataFrame:
    """The 46 Gold columns; ``event_id`` follows as the row id that breaks ties downstream."""
    rows = staged_rows(fact, dim_ad, dim_user)
    out = gold_features(rows, timeline or Timeline.of(rows, look_backs=list(LOOK_BACKS.values()), partition_rows=ROWS_PER_CHAIN))
    out = out.withColumns({c: category_text(F.col(c)) for c in CATEGORICAL_FEATURES})
    out = out.withColumns({"userid_key": F.col("userid"), "adgroup_id_key": F.col("adgroup_id")})
    return out.select(*GOLD_COLUMNS, "event_id")
