"""Point-in-time click history: what was known about a key just before each impression.

All functions take rows arranged on a Timeline, with ``_us``, ``event_id`` and ``click``; see
``prefix.running`` for why nothing here depends on the size of a single key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.constants import DAY_US, SMOOTHING
from clickloom.functions.scalar import ratio, smoothed
from clickloom.operators.prefix import CHUNK, Timeline, by_chunk, running

# Amounts are kept to a millionth, so that they do not depend on the order of summation.
MONEY_DIGITS = 6
LOOK_BACKS = {"1d": DAY_US, "3d": 3 * DAY_US}


def click_history(
    rows: DataFrame, keys: Sequence[str], prefix: str, prior: Column, base: DataFrame | None = None,
) -> DataFrame:
    """Add ``<prefix>_clicks_before``, ``_impressions_before`` and ``_ctr_before``."""
    clicks, shown = f"{prefix}_clicks_before", f"{prefix}_impressions_before"
    out = running(rows, keys, {clicks: F.col("click"), shown: F.lit(1)}, base=base)
    return out.withColumn(f"{prefix}_ctr_before", ratio(F.col(clicks), F.col(shown), prior))


def affinity_history(
    rows: DataFrame, keys: Sequence[str], prefix: str, prior: Column, base: DataFrame | None = None,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """Add clicks, impressions and the smoothed click rate of these keys before the row."""
    clicks, shown = f"{prefix}_clicks_before", f"{prefix}_impressions_before"
    out = running(rows, keys, {clicks: F.col("click"), shown: F.lit(1)}, base=base)
    return out.withColumn(f"{prefix}_affinity_before", smoothed(F.col(clicks), F.col(shown), prior, smoothing))


def windowed_history(
    rows: DataFrame, key: str, prefix: str, prior: Column, timeline: Timeline,
    look_backs: Mapping[str, int] = LOOK_BACKS, revenue: str | None = None, strict: bool = False,
) -> DataFrame:
    """Add the all-time history of ``key`` and its counts and CTR over trailing look-backs.

    A look-back counts earlier rows with a strictly smaller time, not older than its width. Each
    impression enters the count one microsecond after it happened and leaves it one width later;
    a running sum over these entries and exits gives every look-back in linear time, however
    many rows fall into it. What happens after the end of the log reaches no row and is left out;
    ``timeline`` is that of these rows or of a log that ends no sooner. With ``strict`` the all-time history also ignores rows that share
    the timestamp.
    """
    names = list(look_backs)

    def step(at: Column, kind: int, own: int, moves: Mapping[str, int]) -> Column:
        return F.struct(
            at.alias("_at"), F.lit(kind).alias("_kind"), F.lit(own).alias("_own"),
            *[F.lit(moves.get(n, 0)).alias(f"_{n}") for n in names],
        )

    steps = [
        step(F.col("_us"), 1, 0 if strict else 1, {}),
        step(F.col("_us") + 1, 0, 1 if strict else 0, dict.fromkeys(names, 1)),
    ] + [step(F.col("_us") + look_backs[n], 0, 0, {n: -1}) for n in names]
    columns = [c for c in rows.columns if c != CHUNK]
    needed = list(dict.fromkeys([key, "event_id", "click"] + ([revenue] if revenue else [])))
    spread = rows.select(*columns, F.explode(F.array(*steps)).alias("_e")).select(
        F.when(F.col("_e._kind") == 1, F.struct(*columns)).alias("_row"), *needed, "_e.*",
    ).where((F.col("_kind") == 1) | (F.col("_at") <= timeline.last))
    events = timeline.chunked(spread, "_at", "event_id", F.col("_kind"))

    clicks, shown, earned = (f"{prefix}_{m}_before" for m in ("clicks", "impressions", "revenue"))
    sums = {clicks: F.col("_own") * F.col("click"), shown: F.col("_own")}
    if revenue:
        sums[earned] = F.col("_own") * F.col(revenue) * F.col("click")
    for n in names:
        sums[f"{prefix}_impressions_last_{n}"] = F.col(f"_{n}")
        sums[f"{prefix}_clicks_last_{n}"] = F.col(f"_{n}") * F.col("click")
    state = running(
        by_chunk(events), [key], sums, order=("_at", "_kind", "event_id"), base=events
    ).where(F.col("_kind") == 1)
    rates = [
        ratio(F.col(f"{prefix}_clicks_last_{n}"), F.col(f"{prefix}_impressions_last_{n}"), prior).alias(f"{prefix}_ctr_last_{n}")
        for n in names
    ]
    if revenue:
        state = state.withColumn(earned, F.round(earned, MONEY_DIGITS))
    return state.select("_row.*", CHUNK, *sums, ratio(F.col(clicks), F.col(shown), prior).alias(f"{prefix}_ctr_before"), *rates)


def ctr_trend(rows: DataFrame, prefix: str = "ag", short: str = "1d", long: str = "3d") -> DataFrame:
    """Short minus long trailing CTR: positive while the key heats up."""
    return rows.withColumn(
        f"{prefix}_ctr_trend_{short}_vs_{long}",
        F.col(f"{prefix}_ctr_last_{short}") - F.col(f"{prefix}_ctr_last_{long}"),
    )


def day_lags(rows: DataFrame, key: str, prefix: str, prior: Column, timeline: Timeline, lags: int = 3) -> DataFrame:
    """CTR of the 1st, 2nd, … 24 hours back (T-1, T-2, …) and their differences to T-1."""
    looks = {f"{d}d": d * DAY_US for d in range(1, lags + 1)}
    out = windowed_history(rows, key, prefix, prior, timeline, looks)
    for d in range(1, lags + 1):
        shown, clicks = F.col(f"{prefix}_impressions_last_{d}d"), F.col(f"{prefix}_clicks_last_{d}d")
        if d > 1:
            shown = shown - F.col(f"{prefix}_impressions_last_{d - 1}d")
            clicks = clicks - F.col(f"{prefix}_clicks_last_{d - 1}d")
        out = out.withColumn(f"{prefix}_ctr_t{d}", ratio(clicks, shown, prior))
    for d in range(2, lags + 1):
        out = out.withColumn(f"{prefix}_ctr_t1_vs_t{d}", F.col(f"{prefix}_ctr_t1") - F.col(f"{prefix}_ctr_t{d}"))
    return out


def user_history(rows: DataFrame, prior: Column, mean_price: Column | None, base: DataFrame | None = None) -> DataFrame:
    """Add the user's click history, last clicked ad and, if priced, clicked-price features."""
    sums = {"user_clicks_before": F.col("click"), "user_impressions_before": F.lit(1)}
    if mean_price is not None:
        paid = F.when(F.col("click") == 1, F.col("price"))
        sums |= {"_paid": paid, "_paid_n": F.when(paid.isNotNull(), F.lit(1))}
    last = {"user_prev_clicked_item": F.when(F.col("click") == 1, F.col("adgroup_id"))}
    out = running(rows, ["userid"], sums, last, base=base)
    out = out.withColumn("user_ctr_before", ratio(F.col("user_clicks_before"), F.col("user_impressions_before"), prior))
    if mean_price is None:
        return out
    mean = F.round(ratio(F.col("_paid"), F.col("_paid_n"), mean_price), MONEY_DIGITS)
    out = out.withColumn("user_avg_clicked_price_before", mean)
    return out.withColumn("user_price_gap", F.col("price") - F.col("user_avg_clicked_price_before")).drop("_paid", "_paid_n")
