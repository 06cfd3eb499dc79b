"""Sequential co-clicks: how often a click on X was followed by a click on Y."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.scalar import ratio
from clickloom.operators.encode import is_train
from clickloom.operators.prefix import running

PREV = "user_prev_clicked_item"


def with_previous_click(rows: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Add the ad this user clicked last before the row."""
    return running(rows, ["userid"], lasts={PREV: F.when(F.col("click") == 1, F.col("adgroup_id"))}, base=base)


def with_coclick_affinity(rows: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Add P(click this ad | last click was X) from the transitions seen so far; 0 without any."""
    base = rows if base is None else base
    out = running(rows, [PREV], {"_any": F.col("click")}, base=base)
    out = running(out, [PREV, "adgroup_id"], {"_pair": F.col("click")}, base=base)
    return out.withColumn("item_coclick_affinity", ratio(F.col("_pair"), F.col("_any"), 0.0)).drop("_pair", "_any")


def coclick_snapshot(rows: DataFrame, item: str = "adgroup_id") -> DataFrame:
    """Transitions clicked in the train period: (prev_item, item, cnt, total of prev_item)."""
    pairs = (
        rows.where(is_train() & (F.col("click") == 1) & F.col(PREV).isNotNull())
        .groupBy(F.col(PREV).alias("prev_item"), F.col(item).alias("item"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    totals = pairs.groupBy("prev_item").agg(F.sum("cnt").alias("total"))
    return pairs.join(totals, "prev_item")
