"""Scores inside blocks against scores row by row."""

import pytest

from clickloom.constants import RECALL_KS
from clickloom.operators import blockscore, models, ranking
from clickloom.operators.candidates import click_queries, exploded, lookups_of, user_snapshot, with_candidates
from clickloom.operators.encode import is_train
from clickloom.operators.trees import Forest, Growth
from clickloom.operators import trees
from clickloom.plans import training
from clickloom.plans.lake import Lake
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def lake(spark):
    return Lake.at(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def fitted(lake):
    known = lake.inputs.all_rows
    return {
        "logistic": models.fit_logistic(lake.train, 10), "forest": trees.fit_forest(known, Forest(5, 5, 5)),
        "boosted": trees.fit(known, Growth(5, 0.3, 8, 4)),
    }


def test_comparison_equals_scores_of_rows_in_one_and_many_blocks(lake, fitted):
    candidates = exploded(with_candidates(click_queries(lake.gold), lake.lookups))
    test = lake.gold.where(~is_train())
    want = {r.model: r for m, f in fitted.items() for r in models.evaluate(m, f, test, candidates).collect()}
    for block_ads in (1024, 7):
        lookups = lookups_of(lake.gold, lake.catalog, block_ads)
        got = training.compared(fitted, lake.gold, lookups).collect()
        assert [r.auc for r in got] == sorted((r.auc for r in got), reverse=True)
        assert {r.model for r in got} == {*fitted, "popularity", "random"}
        for r in got:
            if r.model in fitted:
                assert all(abs(r[c] - want[r.model][c]) < 1e-9 for c in ["auc", *[f"recall_at_{k}" for k in RECALL_KS]])
    assert lookups.n_blocks > 5


def test_recommendations_equal_scores_of_rows(lake, fitted):
    users = lake.gold.where(~is_train()).select(F.col("userid_key").alias("userid")).distinct()
    lookups = lookups_of(lake.gold, lake.catalog, 7)
    rows = exploded(with_candidates(user_snapshot(lake.gold, users), lake.lookups))
    for model in (fitted["logistic"], fitted["boosted"]):
        want = ranking.recommendations_of_rows(models.scored(model, rows, "userid", "adgroup_id"), size=9)
        got = training.recommend(model, lake.gold, lookups, users, 9)
        plain = lambda df: {r.userid: [(x.adgroup_id, round(x.score, 5)) for x in r.recommendations] for r in df.collect()}
        assert plain(got) == plain(want)


def test_the_own_ad_is_made_without_its_neighbours(lake):
    """One candidate per query, the same as among all ads, whatever the blocks."""
    queries = click_queries(lake.gold)
    plain = lambda df: sorted(map(str, df.select("query_id", F.to_json(F.struct(*sorted(c for c in df.columns if c != "query_id"))).alias("row")).collect()))
    want = plain(exploded(with_candidates(queries, lake.lookups)).where("adgroup_id = true_adgroup_id"))
    for lookups in (lake.lookups, lake.small_blocks):
        own = with_candidates(queries, lookups, own_ad_only=True)
        assert own.where("size(candidates) != 1").isEmpty()
        assert plain(exploded(own)) == want != []
