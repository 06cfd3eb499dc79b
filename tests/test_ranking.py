"""Ranks, recall, lift, recommendations and statistics on small examples."""

import math

import pytest
from pyspark.sql import functions as F

from clickloom.operators import profile, ranking, stats

SCORED = "query_id long, true_adgroup_id long, userid long, scored array<struct<score double, adgroup_id long>>"


def ranks_of(scored):
    """Ranks from the scored rows of one query each, as the row-wise path gives them."""
    rows = scored.select("query_id", "true_adgroup_id", F.explode("scored").alias("s")).select("query_id", "true_adgroup_id", "s.*")
    return ranking.true_ranks_of_rows(rows)


@pytest.fixture
def scored(spark):
    items = [(0.9, 1), (0.5, 2), (0.5, 3), (0.1, 4)]
    return spark.createDataFrame([(0, 1, 7, items), (1, 3, 8, items), (2, 99, 9, items)], SCORED)


def test_true_rank_ties_and_absent_items(scored):
    assert {r.query_id: r["rank"] for r in ranks_of(scored).collect()} == {0: 0, 1: 2, 2: 4}


def test_recall_counts_absent_items_as_misses(scored):
    got = ranking.recall_at(ranks_of(scored), [1, 3, 4]).collect()[0]
    assert [got.recall_at_1, got.recall_at_3, got.recall_at_4] == [pytest.approx(x) for x in (1 / 3, 2 / 3, 2 / 3)]


def test_precision_and_floors(scored):
    got = {r.k: r for r in ranking.precision_at(ranks_of(scored), [1, 4]).collect()}
    assert got[4].precision == pytest.approx(2 / 12) and got[4].random_precision == 0.25 and got[1].random_recall == 0.25
    assert got[1].precision_lift == pytest.approx(4 / 3)


def test_recommendations_are_ordered_and_cut(scored):
    got = ranking.recommendations(scored, size=3).where("userid = 7").collect()[0].recommendations
    assert [(r.adgroup_id, r.score) for r in got] == [(1, 0.9), (2, 0.5), (3, 0.5)]


def test_cheaper_first_on_equal_scores(spark):
    df = spark.createDataFrame([(1, [(0.5, 1, 9.0), (0.5, 2, 3.0), (0.7, 3, 5.0)])], "userid long, scored array<struct<score double, adgroup_id long, price double>>")
    got = ranking.recommendations(df, cheapest_first=True).collect()[0].recommendations
    assert [r.adgroup_id for r in got] == [3, 2, 1]


def test_blocks_of_one_key_are_merged(spark):
    parts = [(7, [(0.1 * i, i) for i in range(k, 40, 4)]) for k in range(4)]
    df = spark.createDataFrame(parts, "userid long, scored array<struct<score double, adgroup_id long>>")
    got = ranking.recommendations(df, size=5).collect()
    assert len(got) == 1 and [r.adgroup_id for r in got[0].recommendations] == [39, 38, 37, 36, 35]
    rows = df.select("userid", F.inline("scored"))
    assert ranking.recommendations_of_rows(rows, size=5).collect() == got


@pytest.fixture(scope="module")
def wide(spark):
    """A Gold-like log with 400 ads, and its catalog in blocks of 64 and of all ads."""
    from clickloom.constants import AD_DYNAMIC, AD_STATIC, CATEGORY_DYNAMIC, USER_CONTEXT
    from clickloom.operators import candidates
    n = F.col("event_id")
    gold = spark.range(4000).withColumnRenamed("id", "event_id").select(
        "event_id", F.timestamp_micros(n * 1_000_000).alias("time_stamp"), F.when(n < 3200, "train").otherwise("test").alias("_split"),
        (n % 400).alias("adgroup_id_key"), (n * 7 % 50).alias("userid_key"), ((n * 13 + n / 7).cast("long") % 3 == 0).cast("int").alias("click"),
        *[F.concat(F.lit(c[:2]), (n % 400 % k).cast("string")).alias(c) for c, k in (("cate_id", 9), ("brand", 11))],
        *[F.concat(F.lit(c[:2]), (n * 7 % 50 % k).cast("string")).alias(c) for c, k in (("pid", 2), ("age_level", 3), ("cms_group_id", 4))],
        (n % 400 * 1.5 + 1).alias("price"), F.when(n % 5 > 0, n * 3 % 400).alias("user_prev_clicked_item"),
        *[(F.abs(F.xxhash64(F.lit(c), n % 400)) % 1000 / 1000).alias(c) for c in AD_DYNAMIC + CATEGORY_DYNAMIC],
        *[F.lit(0).alias(c) for c in USER_CONTEXT if c not in ("pid", "age_level", "cms_group_id", "user_prev_clicked_item")],
    ).cache()
    assert set(AD_STATIC) <= set(gold.columns)
    catalog = candidates.catalog_of(gold)
    return gold, catalog, [candidates.lookups_of(gold, catalog, block_ads=b) for b in (64, 10_000)]


def test_the_catalog_keeps_every_train_ad(wide):
    gold, catalog, (small, large) = wide
    assert catalog.count() == 400 and small.n_blocks == 7 and large.n_blocks == 1


def test_blocks_give_the_ranks_and_recommendations_of_the_whole_catalog(wide):
    from clickloom.operators.candidates import click_queries, exploded, linear_score, user_snapshot, with_candidates, with_scores
    gold, _, lookups = wide
    queries = click_queries(gold)
    ranks = [sorted(map(tuple, ranking.true_ranks(queries, k, linear_score).collect())) for k in lookups]
    assert ranks[0] == ranks[1] and {r[3] for r in ranks[0]} == {400}
    rows = exploded(with_candidates(queries, lookups[0]))
    assert rows.count() == 400 * queries.count()
    scored = rows.withColumn("score", linear_score({c: F.col(c) for c in rows.columns}))
    assert sorted(map(tuple, ranking.true_ranks_of_rows(scored).collect())) == ranks[0]
    users = gold.select(F.col("userid_key").alias("userid")).distinct()
    recs = [sorted(map(str, ranking.recommendations(with_scores(with_candidates(user_snapshot(gold, users), k), linear_score), size=20).collect())) for k in lookups]
    assert recs[0] == recs[1] and len(recs[0]) == 50


def test_blocks_are_skipped_and_nothing_is_lost(wide):
    """67 blocks: those that the range of scores decides are not looked into; ranks and best ads stay those of one block."""
    from clickloom.operators import candidates
    from clickloom.operators.candidates import click_queries, linear_bounds, linear_score, popularity_score, user_snapshot, with_candidates, with_scores
    gold, catalog, (_, one) = wide
    many = candidates.lookups_of(gold, catalog, block_ads=6)
    assert many.n_blocks >= 50
    queries = click_queries(gold)
    for score in (linear_score, popularity_score, ranking.random_score()):
        assert sorted(map(tuple, ranking.true_ranks(queries, many, score).collect())) == sorted(map(tuple, ranking.true_ranks(queries, one, score).collect()))
    users = user_snapshot(gold, gold.select(F.col("userid_key").alias("userid")).distinct())
    for size in (2, 4, 30):
        best = ranking.best_scored(users, many, linear_score, size=size)
        every = with_scores(with_candidates(users, one), linear_score)
        plain = lambda rows: sorted(map(str, ranking.recommendations(rows, size=size).collect()))
        assert plain(best) == plain(every)
        assert size > 2 or best.count() < 0.9 * users.count() * many.n_blocks
    asked = queries.withColumn("_mine", F.lit(0.9))
    rows = with_candidates(asked, many, bounds=linear_bounds, skip=lambda low, up: (up < F.col("_mine")) | (low > F.col("_mine")))
    looked = rows.where("candidates IS NOT NULL").count()
    assert rows.count() == queries.count() * many.n_blocks and 0 < looked < 0.95 * rows.count()


def test_queries_are_dealt_to_as_many_tasks_as_a_shuffle_has(wide):
    """Few bytes of queries that meet many ads are not put into one task."""
    from clickloom.operators.candidates import user_snapshot, with_candidates
    gold, _, (small, _) = wide
    users = user_snapshot(gold, gold.select(F.col("userid_key").alias("userid")).distinct())
    tasks = with_candidates(users, small).groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("userid").alias("n")).collect()
    assert len(tasks) == 8 and sum(r.n for r in tasks) == 50


def test_a_single_block_is_looked_into_once(wide):
    from clickloom.operators.candidates import linear_score, user_snapshot
    gold, _, (_, one) = wide
    users = user_snapshot(gold, gold.select(F.col("userid_key").alias("userid")).distinct())
    assert not [f for f in ranking.best_scored(users, one, linear_score).inputFiles() if "first-blocks" in f]


def test_lift_ranks_rows_without_a_score_last(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (2, None, 1), (3, 0.1, 0), (4, 0.5, 0)], "event_id long, s double, click int")
    got = {r.top_percent: r for r in ranking.lift_table(df, "s", percents=[50, 100]).collect()}
    assert got[100].n_impressions == 4 and got[100].ctr == 0.5 and got[50].ctr == 0.5


def test_correlations_use_the_rows_that_have_both_values(spark):
    rows = [(float(i), float(i * i), None if i % 2 else float(-i)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.feature_a, r.feature_b): r.r for r in stats.correlation_pairs(df, ["a", "b", "c"]).collect()}
    pandas = df.toPandas().corr()
    assert all(v == pytest.approx(pandas.loc[k]) for k, v in got.items()) and len(got) == 3


def test_auc_with_ties(spark):
    rows = [(i, float(i % 5), int(i % 5 + i % 3 > 3)) for i in range(60)]
    got = ranking.auc(spark.createDataFrame(rows, "event_id long, s double, click int"), "s").collect()[0].auc
    pos, neg = [r[1] for r in rows if r[2]], [r[1] for r in rows if not r[2]]
    assert got == pytest.approx(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg))


def test_lift_with_one_score_for_everybody(spark):
    df = spark.createDataFrame([(i, 0.5, int(i < 3)) for i in range(20)], "event_id long, s double, click int")
    got = {r.top_percent: r for r in ranking.lift_table(df, "s").collect()}
    assert got[5].n_impressions == 1 and got[5].ctr == 1.0 and got[100].lift == pytest.approx(1.0)
    assert got[20].ctr == pytest.approx(3 / 4)


def test_recalibration_moves_the_sampled_rate_to_the_real_one(spark):
    got = spark.range(1).select(ranking.recalibrated(F.lit(0.2), 0.2, 0.05)).collect()[0][0]
    assert got == pytest.approx(0.05)


def test_gini_and_top_share(spark):
    df = spark.createDataFrame([(i, n, 0, False) for i, n in enumerate([1, 1, 2, 6])], "userid long, impressions long, clicks long, clicked_at_least_once boolean")
    x, cum = [1, 1, 2, 6], [1, 2, 4, 10]
    assert profile.gini(df).collect()[0].gini == pytest.approx((5 - 2 * sum(cum) / 10) / 4)
    assert profile.top_share(df, 0.5).collect()[0].share == pytest.approx(0.8)


def test_rank_test_against_all_pairs(spark):
    rows = [(float(i * 7 % 11), i % 3 == 0) for i in range(50)]
    df = spark.createDataFrame([(v, int(c)) for v, c in rows], "x double, click int")
    got = stats.rank_test(stats.value_counts(df, ["x"])).collect()[0]
    pos, neg = [v for v, c in rows if c], [v for v, c in rows if not c]
    u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert got.u == u and got.cliffs_delta == pytest.approx(2 * u / len(pos) / len(neg) - 1)
    assert 0 < got.p_value <= 1


def test_erfc(spark):
    xs = [0.0, 0.1, 0.7, 1.5, 3.0, 6.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", stats.erfc(F.col("x")).alias("e")).collect():
        assert r.e == pytest.approx(math.erfc(r.x), rel=2e-7)


def test_effect_labels(spark):
    from clickloom.functions.scalar import effect_label
    df = spark.createDataFrame([(-0.1,), (0.2,), (-0.4,), (0.9,)], "d double")
    assert [r[0] for r in df.select(effect_label(F.col("d"))).collect()] == ["Negligible", "Small", "Medium", "Large"]


def test_all_correlations_from_one_pass_of_sums(spark):
    """Missing, equal and infinite values, and a column far from zero; before, equal values ended in a division by zero."""
    import math
    rows = [(1e9 + i % 7, None if i % 3 else 0.1 * i, 0.1, float((i * i) % 11), math.inf if i == 8 else float(i), 5.0 + i % 2 if i < 30 else None, 0.3 if i < 30 else float(i)) for i in range(60)]
    names = list("abcdefg")
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(4)
    got = {(r.feature_a, r.feature_b): r.r for r in stats.correlation_pairs(df, names, None).collect()}
    pairs = [(a, b) for i, a in enumerate("abdfg") for b in "abdfg"[i + 1:] if a + b != "fg"] + [("b", "e")]      # 0.3 wherever there is an f
    pandas = df.toPandas().corr()
    assert set(got) == set(pairs) and all(got[k] == pytest.approx(pandas.loc[k], abs=1e-7) for k in pairs)
    assert stats.correlation_pairs(df.where("a < 0"), names).count() == 0
