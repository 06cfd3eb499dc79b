"""Lookup joins; Spark broadcasts the tables whose size it knows to be small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def lookup(
    rows: DataFrame, stats: DataFrame, keys: Sequence[str],
    defaults: Mapping[str, Column] | None = None, null_safe: bool = False,
) -> DataFrame:
    """Left join ``stats`` (one row per key) and fill ``defaults`` where no row matches."""
    side = stats.toDF(*[f"_k_{c}" if c in keys else c for c in stats.columns])
    match = F.lit(True)
    for k in keys:
        right = F.col(f"_k_{k}")
        match = match & (F.col(k).eqNullSafe(right) if null_safe else F.col(k) == right)
    out = rows.join(side, match, "left").drop(*[f"_k_{k}" for k in keys])
    return out.withColumns({c: F.coalesce(F.col(c), d) for c, d in (defaults or {}).items()})
