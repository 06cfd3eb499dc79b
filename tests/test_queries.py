"""Named queries against their SQL twins on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
CHOSEN = [
    "a05_split_union", "a06_day_sink", "a09_star_join", "b02_fact_dedup", "b06_unknown_codes", "b14_time_split", "c04_query_catalog",
    "g05_encoded_ids", "g06_counts_chunked", "g06_strict_ties", "g14_coclick_affinity", "g20_interactions", "g21_gold_table",
    "g21_gold_table_chunked", "g26_day_lags", "h01_overview", "h06_segments", "h08_customer_overview", "h10_gini", "h12_frequency_buckets",
    "i05_rank_test", "i08_class_medians", "j05_candidates", "j06_recall", "j12_lift", "j17_first_split", "j19_floors", "j24_top_recommendations", "j26_frequency_cap",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


def rows(df):
    plain = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else v
    return sorted(repr(tuple(map(plain, r))) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", CHOSEN)
def test_same_rows_as_sql(spark, duck, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = duck.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_has_ten_ads(spark):
    assert contract.entry(spark).count() == 10


def test_every_sql_twin_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_distinct_counts_copy_no_rows(spark, capsys):
    contract.queries()["h01_overview"](spark, FOLDER).explain("formatted")
    assert "Expand" not in capsys.readouterr().out
