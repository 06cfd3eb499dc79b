"""The layers as Spark jobs: raw files to Bronze, Bronze to Silver, Silver to Gold."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, SparkSession, functions as F

from clickloom.operators.clean import clean_ads, clean_events, clean_users
from clickloom.operators.coclick import coclick_snapshot
from clickloom.plans.gold import gold_table
from clickloom.plans.training import train
from clickloom.session import exists, prepared
from clickloom.sources import raw

LAYERS = ("bronze", "silver", "gold")


def find_file(spark: SparkSession, folder: str, name: str) -> str:
    """The file of a dimension, zipped or plain."""
    for ending in (".csv.zip", ".csv.gz", ".csv.bz2", ".csv"):
        if exists(spark, f"{folder}/{name}{ending}"):
            return f"{folder}/{name}{ending}"
    raise FileNotFoundError(f"{folder}/{name}.csv[.zip|.gz|.bz2]")


def bronze(spark: SparkSession, source: str, lake: str, ingested_at: Column | None = None) -> str:
    """Land the raw files as they are, with lineage; returns the Bronze folder."""
    instant = raw.now() if ingested_at is None else ingested_at
    out = f"{lake}/bronze"
    raw.write_days(raw.read_events(spark, source, instant), f"{out}/events")
    for name, schema in (("ad_feature", raw.AD_SCHEMA), ("user_profile", raw.USER_SCHEMA)):
        rows = raw.read_dimension(spark, find_file(spark, source, name), schema, instant)
        rows.write.mode("overwrite").parquet(f"{out}/{name}.parquet")
    return out


def silver(spark: SparkSession, lake: str) -> str:
    """Deduplicate, validate and conform into one fact and two dimensions."""
    source, out = f"{lake}/bronze", f"{lake}/silver"
    events = raw.read_days(spark, f"{source}/events").drop("dt")
    raw.write_days(clean_events(events), f"{out}/fact_events")
    clean_ads(spark.read.parquet(f"{source}/ad_feature.parquet")).write.mode("overwrite").parquet(f"{out}/dim_ad.parquet")
    clean_users(spark.read.parquet(f"{source}/user_profile.parquet")).write.mode("overwrite").parquet(f"{out}/dim_user.parquet")
    return out


def gold(spark: SparkSession, lake: str) -> str:
    """Features and the co-click snapshot frozen at the end of train."""
    source, out = f"{lake}/silver", f"{lake}/gold"
    fact = raw.read_days(spark, f"{source}/fact_events").drop("dt")
    # The fact key is unique, so its hash is a row id that every run reproduces.
    fact = fact.withColumn("event_id", F.xxhash64("userid", "adgroup_id", "time_stamp"))
    dims = [spark.read.parquet(f"{source}/{d}.parquet") for d in ("dim_ad", "dim_user")]
    gold_table(fact, *dims).write.mode("overwrite").parquet(f"{out}/training_features.parquet")
    features = spark.read.parquet(f"{out}/training_features.parquet")
    coclick_snapshot(features, "adgroup_id_key").write.mode("overwrite").parquet(f"{out}/item_coclick_snapshot.parquet")
    return out


def run(
    spark: SparkSession, source: str, lake: str, layer: str = "all", ingested_at: Column | None = None, training: dict | None = None,
) -> dict[str, float]:
    """Run one layer or all in order; returns the seconds each took.

    ``train`` comes after ``gold`` and is asked for by name; ``training`` goes to ``training.train``.
    """
    steps: dict[str, Callable[[], str]] = {
        "bronze": lambda: bronze(spark, source, lake, ingested_at),
        "silver": lambda: silver(spark, lake),
        "gold": lambda: gold(spark, lake),
        "train": lambda: train(spark, lake, **(training or {})),
    }
    if layer != "all" and layer not in steps:
        raise ValueError(f"unknown layer {layer!r}, expected one of {', '.join(steps)} or all")
    took = {}
    for name in LAYERS if layer == "all" else (layer,):
        start = time.monotonic()
        with prepared(spark):
            steps[name]()
        took[name] = time.monotonic() - start
    return took
