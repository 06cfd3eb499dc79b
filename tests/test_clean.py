"""Cleaning: dedup, checks, codes."""

import pytest
from pyspark.sql import functions as F

from clickloom.constants import FACT_COLUMNS
from clickloom.functions.scalar import category_text, unknown_code
from clickloom.operators import clean

EVENT = "userid long, adgroup_id long, time_stamp timestamp, click int, pid string, hour int, weekday int, date string, _split string, _source_file string, _block long, _row long"


def events(spark, *clicks):
    from datetime import datetime
    at = datetime(2017, 5, 5, 10)
    return spark.createDataFrame([(1, 10, at, c, "a", 10, 4, "2017-05-05", "train", "f", 0, i) for i, c in enumerate(clicks)], EVENT)


def test_null_becomes_unknown(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (3.0,), (-1.0,)], "c double")
    assert [r[0] for r in rows.select(unknown_code(F.col("c"))).collect()] == ["1", "unknown", "3", "unknown"]


def test_fractional_code_is_an_error(spark):
    with pytest.raises(Exception, match="whole"):
        spark.createDataFrame([(1.5,)], "c double").select(unknown_code(F.col("c"))).collect()


def test_duplicate_event_is_dropped_and_columns_are_fixed(spark):
    out = clean.clean_events(events(spark, 0, 0))
    assert out.count() == 1 and out.columns == FACT_COLUMNS


def test_first_copy_wins(spark):
    assert clean.clean_events(events(spark, 1, 0)).collect()[0].click == 1


@pytest.mark.parametrize("click", [2, None])
def test_click_must_be_binary(spark, click):
    with pytest.raises(Exception, match="binary"):
        clean.clean_events(events(spark, click)).collect()


AD = "adgroup_id long, cate_id long, campaign_id long, customer long, brand double, price double, _source_file string, _block long, _row long"


def test_last_ad_wins_and_brand_is_text(spark):
    rows = spark.createDataFrame([(1, 100, 200, 300, None, 9.9, "f", 0, 0), (1, 100, 201, 300, 400.0, 19.9, "f", 0, 1)], AD)
    got = clean.clean_ads(rows).collect()
    assert len(got) == 1 and got[0].campaign_id == 201 and got[0].brand == "400"


@pytest.mark.parametrize("price", [0.0, -1.0, None])
def test_price_must_be_positive(spark, price):
    with pytest.raises(Exception, match="price"):
        clean.clean_ads(spark.createDataFrame([(1, 100, 200, 300, 400.0, price, "f", 0, 0)], AD)).collect()


def test_a_bad_price_that_is_replaced_later_passes(spark):
    rows = spark.createDataFrame([(1, 1, 1, 1, 1.0, 0.0, "f", 0, 0), (1, 1, 1, 1, 1.0, 5.0, "f", 0, 1)], AD)
    assert clean.clean_ads(rows).collect()[0].price == 5.0


def test_missing_user_levels(spark):
    schema = "userid long, cms_segid long, cms_group_id long, final_gender_code long, age_level long, pvalue_level double, shopping_level long, occupation long, new_user_class_level double, _source_file string, _block long, _row long"
    got = clean.clean_users(spark.createDataFrame([(1, 0, 1, 1, 2, None, 3, 0, None, "f", 0, 0)], schema)).collect()[0]
    assert got.pvalue_level == got.new_user_class_level == "unknown" and got.cms_segid == 0


def test_category_text(spark):
    rows = spark.createDataFrame([(3, None), (None, "x")], "a int, b string")
    assert [tuple(r) for r in rows.select(category_text(F.col("a")), category_text(F.col("b"))).collect()] == [("3", "-1"), ("-1", "x")]


def test_frequent_values_and_duplicates(spark):
    rows = spark.createDataFrame([(i % 5 if i < 20 else 9, i) for i in range(30)], "adgroup_id int, x int")
    assert {r[0] for r in clean.restrict_to_frequent(rows, size=2).select("adgroup_id").collect()} == {9, 0}
    assert clean.duplicate_keys(rows, ["adgroup_id"]).where("n = 10").count() == 1
