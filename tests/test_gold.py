"""Point-in-time features: small examples, tie rules, leaks and independence of the chunking."""

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import coclick, encode, history, prefix
from clickloom.operators.asof import as_of_join
from clickloom.operators.prefix import CHUNK, Timeline, by_chunk, by_value, global_rank, row_position, running

HOUR = 3_600_000_000


def log(spark, rows, schema="event_id long, _us long, userid string, adgroup_id string, click int"):
    return spark.createDataFrame(rows, schema)


def arranged(df, pieces=3):
    return Timeline.of(df, pieces=pieces).arranged(df)


def test_history_excludes_the_row_itself(spark):
    df = arranged(log(spark, [(i, i * HOUR, "u1", "ag1", c) for i, c in enumerate([1, 0, 1])]))
    got = history.click_history(df, ["adgroup_id"], "ag", F.lit(0.4)).orderBy("event_id").collect()
    assert [r.ag_clicks_before for r in got] == [0, 1, 1]
    assert [r.ag_impressions_before for r in got] == [0, 1, 2]
    assert [r.ag_ctr_before for r in got] == [0.4, 1.0, 0.5]


@pytest.mark.parametrize("pieces", [2, 5])
def test_coclick_counts_only_clicked_transitions(spark, pieces):
    rows = [(i, i, "u1", a, c) for i, (a, c) in enumerate([("A", 1), ("B", 1), ("C", 0), ("A", 1), ("B", 0)])]
    df = arranged(log(spark, rows).withColumn("_split", F.when(F.col("event_id") < 4, "train").otherwise("test")), pieces)
    seen = coclick.with_previous_click(df)
    got = coclick.with_coclick_affinity(seen).orderBy("event_id").collect()
    assert [r.user_prev_clicked_item for r in got] == [None, "A", "B", "B", "A"]
    assert got[4].item_coclick_affinity == 1.0
    snapshot = {(r.prev_item, r.item): (r.cnt, r.total) for r in coclick.coclick_snapshot(seen).collect()}
    assert snapshot == {("A", "B"): (1, 1), ("B", "A"): (1, 1)}


def test_affinity_and_clicked_price(spark):
    rows = [(i, i, "u1", f"a{i}", c, "c1", p) for i, (c, p) in enumerate([(1, 10.0), (0, 20.0), (1, 30.0)])]
    df = arranged(log(spark, rows, "event_id long, _us long, userid string, adgroup_id string, click int, cate_id string, price double"))
    out = history.affinity_history(df, ["userid", "cate_id"], "user_cate", F.lit(0.3))
    got = history.user_history(out, F.lit(0.3), F.lit(20.0), df).orderBy("event_id").collect()
    assert got[2].user_cate_affinity_before == pytest.approx((1 + 0.3 * 20) / 22)
    assert got[0].user_avg_clicked_price_before == 20.0 and got[2].user_avg_clicked_price_before == 10.0
    assert got[2].user_price_gap == 20.0


def test_a_null_key_has_no_history(spark):
    df = arranged(log(spark, [(i, i, None, "a", 1) for i in range(6)]))
    got = history.click_history(df, ["userid"], "user", F.lit(0.25)).collect()
    assert {(r.user_clicks_before, r.user_impressions_before, r.user_ctr_before) for r in got} == {(0, 0, 0.25)}


ENC = "event_id long, _split string, cate string, click int"


def test_unseen_key_gets_the_prior_and_folds_are_repeatable(spark):
    rows = [(i, "train", "ab"[i % 2], i % 3 // 2) for i in range(12)] + [(20, "test", "zz", 0), (21, "test", "a", 0)]
    df = spark.createDataFrame(rows, ENC)
    once = {r.event_id: r.cate_te for r in encode.target_encode(df, ["cate"], F.lit(0.37), folds=3).collect()}
    again = {r.event_id: r.cate_te for r in encode.target_encode(df.repartition(5), ["cate"], F.lit(0.37), folds=3).collect()}
    assert once == again and once[20] == 0.37
    n = [r for r in rows if r[1] == "train" and r[2] == "a"]
    assert once[21] == pytest.approx((sum(r[3] for r in n) + 0.37 * 20) / (len(n) + 20))


def test_out_of_fold_ignores_the_own_fold(spark):
    df = spark.createDataFrame([(i, "train", "a", 1) for i in range(4)], ENC)
    got = encode.target_encode(df, ["cate"], F.lit(0.5), fold=(F.col("event_id") % 2).cast("int"), folds=2).collect()
    assert {r.cate_te for r in got} == {(2 + 0.5 * 20) / 22}


def test_ids_are_replaced_by_keys_and_encodings(spark):
    rows = [(i, "train" if i < 5 else "test", i, 10 * (i % 2), 100 * (i % 2), 1000 * (i % 2), i % 2) for i in range(8)]
    df = spark.createDataFrame(rows, "event_id long, _split string, userid long, adgroup_id long, campaign_id long, customer long, click int")
    out = encode.encode_ids(df, F.lit(0.5))
    assert not {"userid", "adgroup_id", "campaign_id", "customer"} & set(out.columns)
    assert {"userid_key", "adgroup_id_key", "userid_te", "adgroup_id_te", "campaign_id_te", "customer_te"} <= set(out.columns)


def test_interaction_share_is_learned_on_train(spark):
    df = spark.createDataFrame([("train", "p1", "c1"), ("train", "p1", "c1"), ("train", "p1", "c2"), ("test", "p2", "c1"), ("train", None, "c1")], "_split string, pid string, cate_id string")
    got = {(r.pid, r.cate_id): r.pid_x_cate_id_freq for r in encode.frequency_encode(df, [("pid", "cate_id")]).collect()}
    assert got[("p1", "c1")] == 0.5 and got[("p2", "c1")] == 0.0 and got[(None, "c1")] == 0.25


def brute(rows, width=None, strict=False):
    """(clicks, impressions) before each row by looking at every earlier one."""
    out = {}
    for i, (eid, us, user, ad, click) in enumerate(rows):
        earlier = [
            r for r in rows
            if r[3] == ad and ((r[1] < us and (width is None or r[1] > us - width)) or (not strict and width is None and r[1] == us and r[0] < eid))
        ]
        out[eid] = (sum(r[4] for r in earlier), len(earlier))
    return out


@pytest.fixture(scope="module")
def tied():
    """One ad owns half of the rows, and many rows share a timestamp."""
    rng = random.Random(7)
    return [(i * 7 % 401, rng.randrange(40) * HOUR, f"u{rng.randrange(9)}", "hot" if rng.random() < 0.5 else f"a{rng.randrange(6)}", int(rng.random() < 0.3)) for i in range(401)]


@pytest.mark.parametrize("pieces", [2, 7, 60])
def test_any_chunking_gives_the_exact_history(spark, tied, pieces):
    df = log(spark, tied)
    line = Timeline.of(df, pieces=pieces)
    out = history.windowed_history(df, "adgroup_id", "ag", F.lit(0.0), line, {"5h": 5 * HOUR, "1d": 24 * HOUR}).collect()
    all_time, five, day = brute(tied), brute(tied, 5 * HOUR), brute(tied, 24 * HOUR)
    for r in out:
        assert (r.ag_clicks_before, r.ag_impressions_before) == all_time[r.event_id]
        assert (r.ag_clicks_last_5h, r.ag_impressions_last_5h) == five[r.event_id]
        assert (r.ag_clicks_last_1d, r.ag_impressions_last_1d) == day[r.event_id]
    assert len(out) == len(tied)


def test_strict_ties_ignore_the_same_timestamp(spark, tied):
    df = log(spark, tied)
    out = history.windowed_history(df, "adgroup_id", "ag", F.lit(0.0), Timeline.of(df, pieces=9), {}, strict=True).collect()
    want = brute(tied, strict=True)
    assert {r.event_id: (r.ag_clicks_before, r.ag_impressions_before) for r in out} == want


def test_chunks_are_dealt_to_the_partitions_evenly(spark):
    """Four chunks in each of 12 partitions; by the hash of 0, 1, ... the fullest had a multiple of the emptiest."""
    df = log(spark, [(i, i * HOUR, "u", "a", 0) for i in range(4800)])
    line = Timeline.of(df, partition_rows=400)
    rows = by_chunk(line.chunked(df)).select(CHUNK, "_us", F.spark_partition_id().alias("task"))
    tasks = [r["count"] for r in rows.groupBy("task").count().collect()]
    assert line.partitions == 12 and len(tasks) == 12 and max(tasks) <= 500
    spans = sorted((r[CHUNK], r.lo, r.hi) for r in rows.groupBy(CHUNK).agg(F.min("_us").alias("lo"), F.max("_us").alias("hi")).collect())
    assert len(spans) == 48 and all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_a_hot_key_and_a_hot_timestamp_are_spread_over_chunks(spark):
    df = log(spark, [(i, 0 if i < 900 else i * HOUR, "u", "hot", 0) for i in range(1000)])
    sizes = [r["count"] for r in Timeline.of(df, pieces=10).chunked(df).groupBy(CHUNK).count().collect()]
    assert len(sizes) >= 9 and max(sizes) <= 200


@pytest.mark.parametrize("burst", [False, True])
def test_look_backs_of_a_third_of_the_log_leave_no_hot_chunk(spark, burst):
    """Entries and exits are spread as evenly as the rows, and what happens after the end is left out."""
    n, width = 3000, 1000 * HOUR
    df = log(spark, [(i, (i % 50 if burst and i < 1500 else i) * HOUR, f"u{i % 7}", f"a{i % 3}", 0) for i in range(n)])
    line = Timeline.of(df, pieces=12, look_backs=[width, 2 * width])
    seen = []
    real = history.by_chunk
    history.by_chunk = lambda events: seen.append(events) or real(events)
    try:
        out = history.windowed_history(df, "adgroup_id", "ag", F.lit(0.0), line, {"1": width, "2": 2 * width})
    finally:
        history.by_chunk = real
    sizes = [r["count"] for r in seen[0].groupBy(CHUNK).count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes) and len(sizes) >= 10
    last = out.orderBy(F.desc("_us")).first()
    assert last.ag_impressions_last_1 == len([i for i in range(n) if i % 3 == (n - 1) % 3 and 0 < (n - 1) - (i % 50 if burst and i < 1500 else i) < 1000])


def test_as_of_join_against_every_earlier_state(spark, tied):
    rows = [(i, us + 1 if i % 3 else us, user) for i, us, user, _, _ in tied] + [(9001, 5 * HOUR, None), (9002, 0, "nobody")]
    states = {}
    for i, us, user, ad, _ in tied:
        states[(user, us)] = max(states.get((user, us), (0, "")), (i, ad))
    left = spark.createDataFrame(rows, "event_id long, _us long, userid string")
    right = spark.createDataFrame([(i, us, user, ad) for (user, us), (i, ad) in states.items()], "event_id long, _us long, userid string, ad string")
    for strict in (False, True):
        got = {r.event_id: r.ad for r in as_of_join(left, right, ["userid"], ["ad"], strict=strict, pieces=5).collect()}
        want = {}
        for i, us, user in rows:
            before = [(t, x) for (u, t), x in states.items() if u == user and (t < us or (t == us and not strict))]
            want[i] = max(before)[1][1] if before else None
        assert got == want


def test_ranks_of_rows_without_a_value_come_last(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0), (4, None)], "event_id long, v double")
    for descending, want in ((True, {3: 0, 1: 1, 2: 2, 4: 3}), (False, {1: 0, 3: 1, 2: 2, 4: 3})):
        got = global_rank(df, "v", "event_id", descending=descending).collect()
        assert {r.event_id: r["rank"] for r in got} == want and {r.rank_of for r in got} == {4}


def test_one_value_of_most_rows_is_spread(spark):
    """90 % of the rows share a value: their ranks follow the ids, and no partition gets them all."""
    df = spark.range(20_000).select(F.col("id").alias("event_id"), F.when(F.col("id") % 10 > 0, 1.0).otherwise(F.col("id") * 1.0).alias("v"))
    ranked = global_rank(df, "v", "event_id")
    got = {r.event_id: r["rank"] for r in ranked.collect()}
    want = sorted(got, key=lambda i: (-(1.0 if i % 10 else float(i)), i))
    assert [got[i] for i in want] == list(range(20_000))
    sizes = [r["count"] for r in ranked.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 8_000


def test_later_rows_never_change_a_feature(spark, tied):
    cut = 20 * HOUR
    whole, part = log(spark, tied), log(spark, [r for r in tied if r[1] < cut])

    def features(df, pieces):
        line = Timeline.of(df, pieces=pieces)
        out = history.windowed_history(df, "adgroup_id", "ag", F.lit(0.1), line)
        out = coclick.with_coclick_affinity(coclick.with_previous_click(out))
        columns = ["event_id", "ag_ctr_before", "ag_ctr_last_1d", "ag_ctr_last_3d", "user_prev_clicked_item", "item_coclick_affinity"]
        return {tuple(r) for r in out.where(F.col("_us") < cut).select(*columns).collect()}

    assert features(whole, 6) == features(part, 4)


def test_running_last_value_crosses_chunks(spark, tied):
    df = arranged(log(spark, tied), 11)
    got = {r.event_id: r.last for r in running(df, ["userid"], lasts={"last": F.when(F.col("click") == 1, F.col("adgroup_id"))}).collect()}
    state, want = {}, {}
    for eid, us, user, ad, click in sorted(tied, key=lambda r: (r[1], r[0])):
        want[eid] = state.get(user)
        if click:
            state[user] = ad
    assert got == want


def test_positions_and_ranks(spark, tied):
    df = log(spark, tied)
    got = {r.event_id: r.position for r in row_position(df, ("_us", "event_id"), Timeline.of(df, pieces=8)).collect()}
    want = {r[0]: i for i, r in enumerate(sorted(tied, key=lambda r: (r[1], r[0])))}
    assert got == want
    ranks = {r.event_id: (r["rank"], r.rank_of) for r in global_rank(df, "_us", "event_id").collect()}
    assert ranks == {r[0]: (i, len(tied)) for i, r in enumerate(sorted(tied, key=lambda r: (-r[1], r[0])))}


def test_hash_ids_over_the_whole_long_range(spark, tied):
    df = log(spark, tied).withColumn("event_id", F.xxhash64("event_id", "_us", "adgroup_id"))
    got = running(arranged(df, 13), ["adgroup_id"], {"n": F.lit(1)}).collect()
    by_ad = {}
    for r in sorted(got, key=lambda r: (r._us, r.event_id)):
        assert r.n == by_ad.get(r.adgroup_id, 0)
        by_ad[r.adgroup_id] = r.n + 1


def test_values_below(spark):
    df = spark.createDataFrame([(float(v % 7), v % 2) for v in range(100)] + [(None, 1)], "x double, click int")
    got = {r.value: (r.n, r.n_below, r.c_below, r.n_total) for r in by_value(df, ["x"], {"n": F.lit(1), "c": F.col("click")}, pieces=4).collect()}
    for v in range(7):
        below = [i for i in range(100) if i % 7 < v]
        assert got[float(v)] == (len([i for i in range(100) if i % 7 == v]), len(below), sum(i % 2 for i in below), 100)


def test_longer_logs_take_more_tasks_not_larger_ones(spark, tied, monkeypatch):
    monkeypatch.setattr(prefix, "ROWS_PER_PARTITION", 20)
    df = log(spark, tied)
    line = Timeline.of(df, look_backs=[5 * HOUR])
    rows = line.arranged(df)
    assert rows.rdd.getNumPartitions() == 21 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = history.windowed_history(df, "adgroup_id", "ag", F.lit(0.0), line, {"5h": 5 * HOUR})
    out = history.click_history(out, ["userid"], "user", F.lit(0.0), line.chunked(df))
    assert out.rdd.getNumPartitions() == 21
    all_time, five = brute(tied), brute(tied, 5 * HOUR)
    got = out.collect()
    assert {r.event_id: (r.ag_clicks_before, r.ag_impressions_before) for r in got} == all_time
    assert {r.event_id: (r.ag_clicks_last_5h, r.ag_impressions_last_5h) for r in got} == five
