"""The impression log, ad catalog and user profile as views on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.functions.scalar import micros, unknown_code

SPLIT_AT = "2024-01-25 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def impressions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per ad shown; ``_us`` is the event time in microseconds."""
    events = table(spark, folder, "events")
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        ts.alias("time_stamp"),
        micros(F.col("ts")).alias("_us"),
        F.col("user_id").alias("userid"),
        F.get_json_object("props", "$.k").cast("bigint").alias("adgroup_id"),
        (F.col("event_type") == "click").cast("int").alias("click"),
        F.concat(F.lit("slot_"), (F.col("event_id") % 2).cast("string")).alias("pid"),
        F.to_date(ts).alias("date"),
        F.hour(ts).alias("hour"),
        F.weekday(ts).alias("weekday"),
        F.when(ts < F.lit(SPLIT_AT).cast("timestamp"), "train").otherwise("test").alias("_split"),
    )


def raw_ads(spark: SparkSession, folder: str) -> DataFrame:
    """Ad catalog as landed: the brand is a nullable float code."""
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.alias("adgroup_id"),
        F.col("p_type").alias("cate_id"),
        F.col("p_size").cast("bigint").alias("campaign_id"),
        (key % 37).alias("customer"),
        F.when(key % 10 != 0, F.substring("p_brand", 7, 10).cast("double")).alias("brand"),
        F.col("p_retailprice").alias("price"),
    )


def raw_users(spark: SparkSession, folder: str) -> DataFrame:
    """User profile as landed: two levels are nullable."""
    key = F.col("c_custkey")
    joined = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return joined.select(
        key.alias("userid"),
        F.col("c_nationkey").cast("bigint").alias("cms_segid"),
        F.col("c_mktsegment").alias("cms_group_id"),
        (key % 2 + 1).alias("final_gender_code"),
        F.col("n_regionkey").cast("bigint").alias("age_level"),
        F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 4000) + 1).alias("pvalue_level"),
        (key % 3 + 1).alias("shopping_level"),
        (key % 7 == 0).cast("bigint").alias("occupation"),
        F.nullif(key % 5, F.lit(0)).alias("new_user_class_level"),
    )


def ads(spark: SparkSession, folder: str) -> DataFrame:
    return raw_ads(spark, folder).withColumn("brand", unknown_code(F.col("brand")))


def users(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_users(spark, folder)
    return raw.withColumns({c: unknown_code(F.col(c)) for c in ("pvalue_level", "new_user_class_level")})


def star(spark: SparkSession, folder: str) -> DataFrame:
    """Impressions with the attributes of their ad and user."""
    return (
        impressions(spark, folder)
        .join(ads(spark, folder), "adgroup_id", "left")
        .join(users(spark, folder), "userid", "left")
    )


def dirty_impressions(spark: SparkSession, folder: str) -> DataFrame:
    """Impressions where every tenth row arrived twice."""
    log = impressions(spark, folder)
    copies = log.where(F.col("event_id") % 10 == 0).withColumn("copy_no", F.lit(1))
    return log.withColumn("copy_no", F.lit(0)).unionByName(copies)


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A second, larger log with whole-day timestamps, hence many ties."""
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return lines.select(
        micros(F.col("o_orderdate")).alias("_us"),
        F.col("o_custkey").alias("userid"),
        F.col("l_partkey").alias("adgroup_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("click"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_shipdate",
    )
