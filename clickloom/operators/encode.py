"""Target, frequency and interaction encodings learned on the train rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.constants import ID_COLUMNS, SMOOTHING
from clickloom.functions.scalar import fold_of, smoothed
from clickloom.operators.joins import lookup
from clickloom.session import materialize_parts



def is_train() -> Column:
    return F.col("_split") == "train"


def train_mean(df: DataFrame, column: str) -> Column:
    """Mean over the train rows: one number, computed once and used as a literal by every plan."""
    return F.lit(df.where(is_train()).agg(F.avg(column)).first()[0]).cast("double")


def target_mean(df: DataFrame, target: str = "click") -> Column:
    return train_mean(df, target)


def fold_sums(
    df: DataFrame, keys: Sequence[str], target: str = "click", fold: Column | None = None, folds: int = 5,
) -> dict[str, DataFrame]:
    """Per key the train clicks and rows, over all folds and inside each fold, as ``_<key>_sums``.

    All keys share one pass over the train rows; the sums are written, one small table per key.
    """
    fold = fold_of(F.col("event_id"), folds) if fold is None else fold
    values = F.array(*[F.struct(F.lit(k).alias("_key"), F.col(k).cast("string").alias("_value")) for k in keys])
    train = df.where(is_train()).select(F.explode(values).alias("_v"), F.col(target).alias("_t"), fold.alias("_f"))
    inside = [F.col("_f") == i for i in range(folds)]
    sums = train.select("_v.*", "_t", "_f").where(F.col("_value").isNotNull()).groupBy("_key", "_value").agg(
        F.sum("_t").alias("s"), F.count("_t").alias("n"),
        F.array(*[F.coalesce(F.sum(F.when(c, F.col("_t"))), F.lit(0)) for c in inside]).alias("fold_s"),
        F.array(*[F.count(F.when(c, F.col("_t"))) for c in inside]).alias("fold_n"),
    )
    types = dict(df.dtypes)
    tables = materialize_parts(sums, "_key", keys, "fold-sums")
    return {
        k: t.select(F.col("_value").cast(types[k]).alias(k), F.struct("s", "n", "fold_s", "fold_n").alias(f"_{k}_sums"))
        for k, t in tables.items()
    }


def encoded(key: str, prior: Column, fold: Column, smoothing: float = SMOOTHING) -> Column:
    """Out-of-fold mean on train rows, full-train mean elsewhere; the prior for unseen keys."""
    sums = F.col(f"_{key}_sums")
    own = fold + F.lit(1)
    oof = smoothed(sums["s"] - F.element_at(sums["fold_s"], own), sums["n"] - F.element_at(sums["fold_n"], own), prior, smoothing)
    full = smoothed(sums["s"], sums["n"], prior, smoothing)
    return F.coalesce(F.when(is_train(), oof).otherwise(full), prior)


def target_encode(
    df: DataFrame, keys: Sequence[str], prior: Column | None = None, fold: Column | None = None,
    folds: int = 5, smoothing: float = SMOOTHING, target: str = "click",
) -> DataFrame:
    """Add ``<key>_te`` for each key."""
    prior = target_mean(df, target) if prior is None else prior
    fold = fold_of(F.col("event_id"), folds) if fold is None else fold
    out = df.withColumn("_fold", fold)
    for k, sums in fold_sums(df, keys, target, fold, folds).items():
        out = lookup(out, sums, [k])
    out = out.withColumns({f"{k}_te": encoded(k, prior, F.col("_fold"), smoothing) for k in keys})
    return out.drop("_fold", *[f"_{k}_sums" for k in keys])


def encode_ids(df: DataFrame, prior: Column | None = None, keys: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """Encode the id columns, keep user and ad as ``*_key`` and drop the raw ids."""
    out = target_encode(df, keys, prior)
    return out.withColumns({"userid_key": F.col("userid"), "adgroup_id_key": F.col("adgroup_id")}).drop(*keys)


def train_counts(df: DataFrame, groups: Sequence[Sequence[str]]) -> tuple[Column, list[DataFrame]]:
    """Train rows in total and per combination of each group of columns, from one pass.

    Each table holds the key columns and ``_n``; a null is a value like any other.
    """
    width = max(len(g) for g in groups)
    combos = F.array(*[
        F.struct(F.lit(f"g{i}").alias("_group"), *[
            (F.col(g[j]).cast("string") if j < len(g) else F.lit(None).cast("string")).alias(f"_v{j}") for j in range(width)
        ]) for i, g in enumerate(groups)
    ])
    rows = df.where(is_train()).select(F.explode(combos).alias("_c")).select("_c.*")
    counts = rows.groupBy("_group", *[f"_v{j}" for j in range(width)]).agg(F.count(F.lit(1)).alias("_n"))
    tables = materialize_parts(counts, "_group", [f"g{i}" for i in range(len(groups))], "train-counts")
    types = dict(df.dtypes)
    total = tables["g0"].agg(F.sum("_n")).first()[0]
    return F.lit(total).cast("double"), [
        t.select(*[F.col(f"_v{j}").cast(types[c]).alias(c) for j, c in enumerate(g)], "_n") for g, t in zip(groups, tables.values())
    ]


def frequency_encode(df: DataFrame, groups: Sequence[Sequence[str]], base: DataFrame | None = None) -> DataFrame:
    """Add ``<a>_x_<b>_freq`` (or ``<a>_freq``) for each group of columns; 0 if unseen in train.

    The shares are counted on ``base``: the same rows, without the columns derived so far.
    """
    total, tables = train_counts(df if base is None else base, groups)
    out = df
    for keys, counts in zip(groups, tables):
        name = "_x_".join(keys) + "_freq"
        shares = counts.select(*keys, (F.col("_n") / total).alias(name))
        out = lookup(out, shares, keys, defaults={name: F.lit(0.0)}, null_safe=True)
    return out


def count_encode(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``<key>_count``: train rows with this value."""
    _, tables = train_counts(df, [[k] for k in keys])
    out = df
    for k, counts in zip(keys, tables):
        out = lookup(out, counts.withColumnRenamed("_n", f"{k}_count"), [k], defaults={f"{k}_count": F.lit(0)}, null_safe=True)
    return out


def standardized_log_price(df: DataFrame) -> DataFrame:
    """``log1p(price)``, centred and scaled by the train mean and population deviation."""
    train = df.where(is_train()).select(F.log1p("price").alias("_x"))
    mean = train.agg(F.avg("_x")).scalar()
    dev = train.agg(F.stddev_pop("_x")).scalar()
    return df.withColumn("price_log", F.log1p("price")).withColumn("price_z", (F.col("price_log") - mean) / F.nullif(dev, F.lit(0.0)))
