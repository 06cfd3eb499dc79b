"""Deduplication, validation and conforming of landed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.constants import AD_COLUMNS, FACT_COLUMNS, FACT_KEY, USER_COLUMNS
from clickloom.functions.scalar import unknown_code

# Where a landed row stood in its source: file, block inside the file, row inside the block.
SOURCE_ORDER = ("_source_file", "_block", "_row")


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    # An aggregate, not a window: copies of one key already collapse before the shuffle.
    kept = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_kept"))
    return kept.select(*keys, "_kept.*").select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, order, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, order, last=True)


def holds(condition: Column) -> Column:
    """The condition, with null counted as broken."""
    return F.coalesce(condition, F.lit(False))


def violations(df: DataFrame, **rules: Column) -> DataFrame:
    """One row with the number of rows that break each rule."""
    return df.agg(*[F.count_if(~holds(c)).alias(n) for n, c in rules.items()])


def guarded(value: Column, condition: Column, message: str) -> Column:
    """``value``, or a failing job with ``message`` where the condition does not hold."""
    return F.when(holds(condition), value).otherwise(F.raise_error(F.lit(message)))


def is_binary(name: str = "click") -> Column:
    return F.col(name).isin(0, 1)


def is_positive(name: str = "price") -> Column:
    return F.col(name) > 0


def clean_events(bronze: DataFrame, order: Sequence[str] = SOURCE_ORDER) -> DataFrame:
    """One row per (user, ad, time) with a validated click.

    Split files count in the order they were listed, so of a train and a test copy train stays.
    """
    listed = ["_source_no"] if "_source_no" in bronze.columns else []
    kept = keep_first(bronze, FACT_KEY, [*listed, *order])
    extra = [c for c in ("event_id",) if c in bronze.columns]
    return kept.withColumn("click", guarded(F.col("click"), is_binary(), "click must be binary")).select(*FACT_COLUMNS, *extra)


def clean_ads(bronze: DataFrame, order: Sequence[str] = SOURCE_ORDER) -> DataFrame:
    """The last row per ad, price checked after the dedup, brand as text."""
    kept = keep_last(bronze, ["adgroup_id"], order)
    return kept.withColumns({
        "price": guarded(F.col("price"), is_positive(), "price must be positive"),
        "brand": unknown_code(F.col("brand")),
    }).select(*AD_COLUMNS)


def clean_users(bronze: DataFrame, order: Sequence[str] = SOURCE_ORDER) -> DataFrame:
    """The last row per user with both nullable levels as text; segment 0 stays a segment."""
    kept = keep_last(bronze, ["userid"], order)
    levels = ("pvalue_level", "new_user_class_level")
    return kept.withColumns({c: unknown_code(F.col(c)) for c in levels}).select(*USER_COLUMNS)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def most_frequent(df: DataFrame, key: str, size: int) -> DataFrame:
    """The ``size`` most frequent values, ties by value."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), key).limit(size)


def restrict_to_frequent(df: DataFrame, key: str = "adgroup_id", size: int = 300) -> DataFrame:
    """Rows of the most frequent values only."""
    return df.join(F.broadcast(most_frequent(df, key, size).select(key)), key, "left_semi")
