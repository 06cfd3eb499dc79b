"""Running totals and ranks that stay parallel under key skew.

A window over one key is one task, and a single ad, category or user can own a large part of
the log. Every running quantity here is therefore computed in two levels: the ordered data is
cut into consecutive, equally full chunks; a window runs inside (chunk, key); and what the key
brought along from earlier chunks is added from an aggregated table. Chunks depend on the row
values only, so any number of keys shares one shuffle on the chunk. Logs of every size take this plan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from clickloom.session import materialize

CHUNK = "_chunk"
ROW_ORDER = ("_us", "event_id")
INF = float("inf")
# Chunks at several places of the order even out how many rows each partition gets.
CHUNKS_PER_PARTITION = 4
# Longer logs take more tasks instead of larger ones; a chain of many windows, which holds a sort for each in one task, takes fewer rows.
ROWS_PER_PARTITION = 200_000
ROWS_PER_CHAIN = 50_000
PARTITIONS = "partitions"       # what the chunk column says about the number of partitions its rows are dealt to


def pieces_of(df: DataFrame) -> int:
    """As many pieces as the cluster uses for a shuffle of this size."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def quantile_splits(df: DataFrame, columns: Sequence[str], pieces: int) -> dict[str, list[float]]:
    """Bucket borders with about equally many rows in between, one job for all columns.

    Results never depend on the borders, so a sketch of a few points per piece is exact enough.
    """
    if pieces < 2:
        return {c: [-INF, INF] for c in columns}
    steps = [i / pieces for i in range(1, pieces)]
    row = df.agg(*[
        F.percentile_approx(F.col(c).cast("double"), steps, max(1_000, 8 * pieces)).alias(f"q{i}")
        for i, c in enumerate(columns)
    ]).first()
    return {c: [-INF, *sorted({x for x in row[f"q{i}"] or [] if math.isfinite(x)}), INF] for i, c in enumerate(columns)}


def bucketize(df: DataFrame, splits: Mapping[str, list[float]], suffix: str) -> DataFrame:
    """Add the integer bucket number of each column as ``<column><suffix>``."""
    cut = {c: s for c, s in splits.items() if len(s) > 2}
    out = df
    if cut:
        out = Bucketizer(
            inputCols=list(cut), outputCols=[c + suffix for c in cut], splitsArray=list(cut.values()),
            handleInvalid="keep",
        ).transform(df)
    return out.withColumns({
        c + suffix: (F.col(c + suffix) if c in cut else F.lit(0)).cast("int") for c in splits
    })


def even_numbers(spark: SparkSession, count: int, partitions: int) -> list[int]:
    """``count`` rising numbers that a shuffle on them deals to the partitions evenly: none gets more than its share, rounded up.

    Plain numbers 0, 1, ... would meet by their hash, and the fullest of many partitions would get a multiple of its share.
    """
    share, found, load, start = -(-count // partitions), [], [0] * partitions, 0
    while len(found) < count:
        end = start + max(1_000, 8 * count)
        number = F.col("id").cast("int")
        for row in spark.range(start, end, 1, 1).select(number.alias("n"), F.pmod(F.hash(number), F.lit(partitions)).alias("p")).collect():
            if len(found) < count and load[row["p"]] < share:
                load[row["p"]] += 1
                found.append(row["n"])
        start = end
    return found


@dataclass(frozen=True)
class Timeline:
    """Borders that cut a log, ordered by (time, kind, id), into consecutive chunks.

    The position of a row is its time in microseconds plus a fraction below one made of its kind
    and id. It never decreases along the order, so chunks follow the order, and rows that share
    one timestamp can still be spread over several chunks by their ids. Times are exact as
    doubles (below 2**53 microseconds); ids may use all 64 bits.
    """

    base: int
    last: int
    id_low: int
    id_span: int
    splits: tuple[float, ...] = (-INF, INF)
    partitions: int | None = None     # by default as many as the session uses
    numbers: tuple[int, ...] = ()     # of the chunks, rising; by default 0, 1, ...

    @classmethod
    def of(
        cls, df: DataFrame, at: str = "_us", row_id: str = "event_id", pieces: int | None = None, look_backs: Sequence[int] = (),
        partition_rows: int | None = None,
    ) -> Timeline:
        """Measure a log and cut it into ``pieces`` chunks, by default several per partition.

        Partitions are as many as the session uses for a shuffle, and more where these would hold more than ``partition_rows``
        (``ROWS_PER_PARTITION``) rows. Rows that leave look-backs of these widths later on count in the chunks they leave in, as
        far as that is not after the end of the log.
        """
        low, high, id_low, id_high, rows = df.agg(F.min(at), F.max(at), F.min(row_id), F.max(row_id), F.count(F.lit(1))).first()
        partitions = None if pieces else max(pieces_of(df), -(-rows // (partition_rows or ROWS_PER_PARTITION)))
        line = cls(low or 0, high or 0, id_low or 0, (id_high or 0) - (id_low or 0) + 1, partitions=partitions)
        moments = F.explode(F.array(F.col(at), *[F.col(at) + w for w in look_backs])).alias("_at")
        probe = df.select(moments, row_id).where(F.col("_at") <= line.last)
        probe = probe.select(line.position(F.col("_at"), F.col(row_id), F.lit(1)).alias("_pos"))
        splits = quantile_splits(probe, ["_pos"], pieces or CHUNKS_PER_PARTITION * partitions)["_pos"]
        numbers = even_numbers(df.sparkSession, len(splits) - 1, partitions) if partitions else ()
        return replace(line, splits=tuple(splits), numbers=tuple(numbers))

    def position(self, at: Column, row_id: Column, kind: Column) -> Column:
        share = (row_id.cast("double") - F.lit(float(self.id_low))) / F.lit(float(self.id_span))
        return (at.cast("double") - F.lit(float(self.base))) + (kind + share) / F.lit(2.0)

    def chunked(self, df: DataFrame, at: str = "_us", row_id: str = "event_id", kind: Column | None = None) -> DataFrame:
        """Add the chunk column."""
        position = self.position(F.col(at), F.col(row_id), F.lit(1) if kind is None else kind)
        placed = bucketize(df.withColumn("_pos", position), {"_pos": list(self.splits)}, "_n")
        number = F.col("_pos_n")
        if self.numbers:
            number = F.coalesce(F.get(F.lit(list(self.numbers)), number), F.lit(self.numbers[-1] + 1))     # rows without a time
        number = number.cast("int").alias(CHUNK, metadata={PARTITIONS: self.partitions} if self.partitions else {})
        return placed.select(*df.columns, number)

    def arranged(self, df: DataFrame, at: str = "_us", row_id: str = "event_id", kind: Column | None = None) -> DataFrame:
        return by_chunk(self.chunked(df, at, row_id, kind))


def by_chunk(df: DataFrame) -> DataFrame:
    """Rows hashed on the chunk alone, so that windows of all keys share the shuffle.

    The number of partitions is the timeline's: adaptive execution does not merge them into larger tasks.
    """
    partitions = df.schema[CHUNK].metadata.get(PARTITIONS)
    return df.repartition(partitions, CHUNK) if partitions else df.repartition(CHUNK)


def running(
    rows: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    order: Sequence[str] = ROW_ORDER,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add to each row what the earlier rows with the same keys add up to.

    ``sums`` become running sums (0 without history), ``lasts`` the last non-null value (null
    without history); the row itself is never included. Rows with a null key have no history.
    ``rows`` are arranged on a timeline; ``base`` holds the same chunked rows without derived
    columns, so that the carried totals do not recompute earlier steps.
    """
    sums, lasts = sums or {}, lasts or {}
    base = rows if base is None else base
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()

    zero = F.lit(0)
    before = W.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = rows.withColumns(
        {f"_in_{n}": F.sum(c).over(before) for n, c in sums.items()}
        | {f"_in_{n}": F.last(c, ignorenulls=True).over(before) for n, c in lasts.items()}
    )

    totals = base.where(keyed).groupBy(*keys, CHUNK).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()],
        *[F.max_by(c, F.when(c.isNotNull(), F.struct(*order))).alias(n) for n, c in lasts.items()],
    )
    earlier = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(
        *keys, CHUNK,
        *[F.sum(n).over(earlier).alias(f"_from_{n}") for n in sums],
        *[F.last(n, ignorenulls=True).over(earlier).alias(f"_from_{n}") for n in lasts],
    )
    useful = F.lit(False)
    for n in [*sums, *lasts]:
        useful = useful | F.col(f"_from_{n}").isNotNull()

    joined = local.join(carry.where(useful), [*keys, CHUNK], "left")
    out = {
        n: F.when(keyed, F.coalesce(F.col(f"_in_{n}"), zero) + F.coalesce(F.col(f"_from_{n}"), zero)).otherwise(zero)
        for n in sums
    } | {n: F.when(keyed, F.coalesce(F.col(f"_in_{n}"), F.col(f"_from_{n}"))) for n in lasts}
    return joined.withColumns(out).drop(*[f"{p}_{n}" for p in ("_in", "_from") for n in out])


def row_position(df: DataFrame, order: Sequence[str], timeline: Timeline, name: str = "position") -> DataFrame:
    """Number the rows 0, 1, … along the order of the timeline."""
    at, row_id = order
    flat = timeline.chunked(df, at, row_id).withColumn("_all", F.lit(0))
    return running(by_chunk(flat), ["_all"], {name: F.lit(1)}, order=order, base=flat).drop("_all", CHUNK)


def by_value(df: DataFrame, columns: Sequence[str], sums: Mapping[str, Column], pieces: int | None = None) -> DataFrame:
    """Distinct values of each column with sums at, below and over all values.

    Returns (feature, value, <sum>, <sum>_below, <sum>_total) per distinct non-null value. Equal
    values collapse before the shuffle; the distinct values are then ordered in parallel buckets.
    """
    keep = {f"_m_{n}": c for n, c in sums.items()}
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns], *[c.alias(n) for n, c in keep.items()])
    splits = quantile_splits(wide, columns, pieces or pieces_of(df))
    wide = bucketize(wide, splits, "__b")
    melted = wide.select(
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("feature"), F.col(f"`{c}__b`").alias("_b"), F.col(c).alias("value"))
            for i, c in enumerate(columns, 1)
        ])), *keep,
    )
    names = F.array(*[F.lit(c) for c in columns])
    return _cumulated(melted, sums).withColumn("feature", F.element_at(names, F.col("feature")))


def _cumulated(melted: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    flat = melted.where(F.col("value").isNotNull()).groupBy("feature", "_b", "value").agg(
        *[F.sum(f"_m_{n}").alias(n) for n in sums]
    )
    inner = W.partitionBy("feature", "_b").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    buckets = flat.groupBy("feature", "_b").agg(*[F.sum(n).alias(n) for n in sums])
    earlier = W.partitionBy("feature").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    overall = W.partitionBy("feature")
    carry = buckets.select(
        "feature", "_b",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_from_{n}") for n in sums],
        *[F.sum(n).over(overall).alias(f"{n}_total") for n in sums],
    )
    local = flat.withColumns({f"_in_{n}": F.sum(n).over(inner) for n in sums})
    return local.join(carry, ["feature", "_b"]).select(
        "feature", "value", *sums,
        *[(F.coalesce(F.col(f"_in_{n}"), F.lit(0)) + F.col(f"_from_{n}")).alias(f"{n}_below") for n in sums],
        *[f"{n}_total" for n in sums],
    )


def numbered(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Number the rows 0, 1, ... along any order, in one exchange: dealt by ranges, sorted and numbered inside a partition, plus
    the rows of the partitions before it. The rows are written once numbered, so that a lost executor cannot renumber them.
    """
    inside = F.monotonically_increasing_id()      # the partition above 33 bits, the place inside it below
    placed = df.repartitionByRange(pieces_of(df), *order).sortWithinPartitions(*order).withColumn("_at", inside)
    placed = materialize(placed, "numbered")
    part = F.shiftright("_at", 33).cast("int")
    counts = dict(placed.groupBy(part.alias("_part")).count().collect())      # a row per partition
    before, total = [], 0
    for k in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(k, 0)
    earlier = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in before or [0]]), part + 1)
    return placed.withColumns({name: earlier + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)), f"{name}_of": F.lit(total).cast("bigint")}).drop("_at")


def global_rank(df: DataFrame, value: str, row_id: str, descending: bool = True, name: str = "rank") -> DataFrame:
    """0-based rank of each row by value, ties by row id, plus the row count as ``<rank>_of``.

    Rows without a value are ranked last. Rows of one value are spread by their ids.
    """
    number = F.col(value).cast("double")
    return numbered(df, F.desc_nulls_last(number) if descending else F.asc_nulls_last(number), F.col(row_id), name=name)
