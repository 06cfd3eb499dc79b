"""As-of join: the state of a key in another table just before each row's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.prefix import Timeline, running


def as_of_join(
    rows: DataFrame, states: DataFrame, keys: Sequence[str], values: Sequence[str],
    at: str = "_us", row_id: str = "event_id", strict: bool = False, pieces: int | None = None,
) -> DataFrame:
    """Add to ``rows`` the ``values`` of the last row of ``states`` with the same keys.

    The last one at or before the row's time counts, with ``strict`` the last one before it; of
    equal times the greatest ``row_id`` is the last. Rows without a state, or with a null key, get
    nulls. Both tables are stacked into one log and meet as a running last value over its chunks,
    so neither a key with most of the rows nor the distance to its state matters.
    """
    # At equal times a state comes before a row it counts for, and after one it does not.
    here, there = (0, 1) if strict else (1, 0)
    own = rows.select(
        F.struct(*rows.columns).alias("_row"), *keys, F.col(at).alias("_at"), F.col(row_id).alias("_id"),
        F.lit(here).alias("_kind"), F.lit(None).cast(states.select(F.struct(*values)).schema[0].dataType).alias("_state"),
    )
    other = states.select(
        F.lit(None).cast(own.schema["_row"].dataType).alias("_row"), *keys, F.col(at).alias("_at"), F.col(row_id).alias("_id"),
        F.lit(there).alias("_kind"), F.struct(*values).alias("_state"),
    )
    log = own.unionByName(other)
    line = Timeline.of(log, "_at", "_id", pieces)
    placed = line.arranged(log, "_at", "_id", F.col("_kind"))
    seen = running(placed, keys, lasts={"_last": F.col("_state")}, order=("_at", "_kind", "_id"))
    return seen.where(F.col("_row").isNotNull()).select("_row.*", *[F.col(f"_last.{v}").alias(v) for v in values])
