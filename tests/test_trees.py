"""Trees on binned rows: splits against brute force, fits that do not depend on how rows are dealt."""

import math
from dataclasses import replace
from threading import Barrier

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.constants import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from clickloom.operators import models, ranking, trees
from clickloom.operators.encode import is_train
from clickloom.operators.trees import Forest, Growth, Prepared
from clickloom.plans.lake import Lake


@pytest.fixture(scope="module")
def lake(spark):
    return Lake.at(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def known(lake):
    return Prepared.of(lake.train)


def rows_of(blocks, features):
    parts = blocks.collect()
    bins = np.concatenate([np.frombuffer(r.bins, np.uint8).reshape(features, -1) for r in parts], axis=1)
    label = np.concatenate([np.frombuffer(r.label, np.uint8) for r in parts])
    return bins, label.astype(float)


def slow_tree(bins, gradient, hessian, grow):
    """Best leaf first, one at a time, every split tried by sums over the rows themselves."""
    def split_of(rows, depth):
        if depth >= grow.depth or len(rows) < 2 * grow.min_rows:
            return None
        part = lambda r: gradient[r].sum() ** 2 / max(hessian[r].sum() + grow.ridge, 1e-12)
        found = None
        for f in range(len(bins)):
            for cut in sorted(set(bins[f][rows]))[:-1]:
                left, right = rows[bins[f][rows] <= cut], rows[bins[f][rows] > cut]
                if min(len(left), len(right)) < max(1, grow.min_rows) or min(hessian[left].sum(), hessian[right].sum()) < grow.min_hessian:
                    continue
                gain = part(left) + part(right) - part(rows)
                if gain > 1e-10 and (found is None or gain > found[0]):
                    found = gain, f, left, right
        return found
    leaves = [(np.arange(bins.shape[1]), 0)]
    splits = [split_of(*leaves[0])]
    done = 0
    while done < grow.leaves - 1 and any(splits):
        at = max((i for i in range(len(leaves)) if splits[i]), key=lambda i: splits[i][0])
        _, _, left, right = splits[at]
        depth = leaves[at][1] + 1
        leaves[at], splits[at] = (left, depth), split_of(left, depth)
        leaves.append((right, depth)), splits.append(split_of(right, depth))
        done += 1
    value = np.empty(bins.shape[1])
    for rows, _ in leaves:
        value[rows] = -grow.step * gradient[rows].sum() / (hessian[rows].sum() + grow.ridge)
    return value


@pytest.mark.parametrize("grow", [Growth(1, 0.1, 8, 100), Growth(1, 0.1, 16, 4, 10, 0.0, 2.0), Growth(1, 0.5, 63, 6, 3, 1.5, 1.0), Growth(1, 0.5, 5, 100, 30)])
def test_a_tree_is_the_best_leaf_first_tree(grow):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 12, (5, 300)).astype(np.uint8)
    p = rng.random(300)
    label = (rng.random(300) < 1 / (1 + np.exp((bins[2] % 3) - 2.0 * (bins[0] > 6)))).astype(float)
    gradient, hessian = np.rint((p - label) * trees.UNIT), np.rint(p * (1 - p) * trees.UNIT)

    scaled = replace(grow, ridge=grow.ridge * trees.UNIT, min_hessian=grow.min_hessian * trees.UNIT)
    tree = trees.grow_tree(bins, np.arange(300), gradient, hessian, scaled, lambda x: x)
    got = tree.value[tree.leaves_of(bins)]
    assert np.allclose(got, slow_tree(bins, gradient, hessian, scaled))
    assert (tree.feature < 0).sum() <= grow.leaves


def test_tasks_and_segments_do_not_change_the_trees(known):
    grow, n = Growth(9, 0.3, 8, 4, 5), len(known.cuts)
    blocks = trees.materialize(known.blocks.repartition(1), "blocks")
    small = [r for r in blocks.collect()]
    cut = [{"rows": 100, "bins": np.frombuffer(r.bins, np.uint8).reshape(n, -1)[:, k:k + 100].tobytes(), "label": r.label[k:k + 100], "held": r.held[k:k + 100]}
           for r in small for k in range(0, r.rows - 99, 100)]
    blocks = blocks.sparkSession.createDataFrame([(c["rows"], c["bins"], bytes(c["label"]), bytes(c["held"])) for c in cut], blocks.schema)
    one, _ = trees.fitted_trees(blocks, n, -1.0, grow, tasks=1)
    assert one == trees.fitted_trees(blocks, n, -1.0, grow, tasks=3)[0]
    assert one == trees.fitted_trees(blocks, n, -1.0, grow, tasks=2, segment=4)[0]
    assert len(one) == 9


def test_early_stop_gives_every_round_its_judgement(lake):
    held = Prepared.of(models.with_validation_flag(lake.train), F.col("is_validation"))
    for metric in ("loss", "auc"):
        grow = Growth(30, 0.5, 8, 3, metric=metric)
        found, history = trees.search(held, grow, patience=4, tasks=2)
        assert history == trees.fitted_trees(held.blocks, len(held.cuts), trees.log_odds(held.clicks), grow, 4, 1, segment=3)[1]
        assert len(history) == len(found) and (len(found) == 30 or len(found) - 1 - int(np.argmin(history)) == 4)


def test_scores_fall_with_every_round_on_the_train_rows(lake, known):
    loss = [ranking.log_loss(trees.fit(known, Growth(r, 0.2, 8, 4)).scored(lake.train, "click"), "score").first()[0] for r in (1, 5, 20)]
    assert loss[0] > loss[1] > loss[2]


def test_scores_are_those_of_the_binned_rows(lake, known):
    model = trees.fit(known, Growth(5, 0.3, 8, 4))
    bins, _ = rows_of(known.blocks, len(known.cuts))
    raw = np.full(bins.shape[1], model.base)
    for plain in model.trees:
        tree = trees.Tree.of(plain)
        raw += tree.value[tree.leaves_of(bins)]
    got = sorted(r.score for r in model.scored(lake.train).collect())
    assert np.allclose(got, np.sort(trees.probability_of(raw)))


def test_a_forest_does_not_depend_on_its_groups(known):
    forest = Forest(trees=7, depth=6, min_rows=5)
    assert trees.forest_trees(known.blocks, len(known.cuts), forest, 1) == trees.forest_trees(known.blocks, len(known.cuts), forest, 3)


def test_forest_leaves_hold_means_of_enough_rows(known):
    bins, label = rows_of(known.blocks, len(known.cuts))
    tree = trees.forest_tree(bins, label, Forest(1, 8, 5), 3)
    rng = np.random.default_rng((42, 3))
    weight = rng.poisson(1.0, len(label)).astype(float)
    leaf = tree.leaves_of(bins)
    for k in np.unique(leaf):
        mine = leaf == k
        assert weight[mine].sum() >= 5 and math.isclose(tree.value[k], (weight * label)[mine].sum() / weight[mine].sum())
    assert len(np.unique(leaf)) > 10


def test_many_brands_need_no_list(spark):
    """200,000 categories are a written table; unseen ones read the prior."""
    rows = spark.range(400_000).select(
        F.col("id").alias("event_id"), F.concat(F.lit("b"), F.col("id") % 200_000).alias("brand"),
        (F.xxhash64(F.col("id") % 200_000) % 100 < 0).cast("int").alias("click"), (F.col("id") % 7).cast("double").alias("price"))
    known = Prepared.of(rows, numeric=["price"], categorical=["brand"])
    assert known.categories.count() == 200_000 and all(len(c) <= trees.CUTS for c in known.cuts)
    model = trees.TreeModel(Growth(4, 0.5, 4, 2), trees.log_odds(known.clicks), known.cuts, trees.fitted_trees(known.blocks, 2, 0.0, Growth(4, 0.5, 4, 2))[0],
                            known.categories, known.clicks, ("price", "brand_rate"))
    some = rows.where("event_id < 1000").unionByName(rows.limit(1).withColumns({"brand": F.lit("new"), "event_id": F.lit(-1)}))
    assert ranking.auc(model.scored(some.where("event_id >= 0"), "click"), "score").first()[0] > 0.9
    assert model.scored(some, "event_id").where("score IS NULL").count() == 0


def test_save_and_load(lake, known, tmp_path):
    for model in (trees.fit(known, Growth(3, 0.3, 8, 4)), trees.fit_forest(known, Forest(3, 5, 5))):
        models.save_bundle(model, "m", str(tmp_path / "b"))
        again, _ = models.load_bundle(str(tmp_path / "b"))
        scores = lambda m: [r.score for r in m.scored(lake.gold.where(~is_train()), "event_id").orderBy("event_id").collect()]
        assert scores(model) == scores(again)
        assert math.isclose(sum(w for _, w in model.importance()), 1) and {n for n, _ in model.importance()} == {*NUMERIC_FEATURES, *CATEGORICAL_FEATURES}


def test_missing_numbers_are_below_all_others():
    bins = trees.binned(np.array([[np.nan, -5.0, 1.0, 2.0, 9.0]]), [[1.0, 2.0]])
    assert bins.tolist() == [[0, 1, 1, 2, 3]]


def passes(blocks, folder):
    """The blocks, leaving a file behind for every partition that is read, each time it is read."""
    def touch(batches):
        import tempfile
        from pyspark import TaskContext
        tempfile.mkstemp(prefix=f"{TaskContext.get().partitionId()}-", dir=folder)
        yield from batches
    return blocks.mapInArrow(touch, blocks.schema)


def test_a_fit_of_many_tasks_runs_once(known, tmp_path):
    counted = passes(known.blocks.coalesce(1), str(tmp_path))
    trees.fitted_trees(counted, len(known.cuts), 0.0, Growth(rounds=2, step=0.1, leaves=4, depth=3), tasks=2)
    # Once to count the rows, once to deal them; sorting the trees in Spark made it three.
    assert len(list(tmp_path.iterdir())) == 2


def test_every_group_of_trees_has_a_task_of_its_own(known):
    for groups in (8, 12):
        dealt = trees.dealt_to_groups(known.blocks, groups)
        places = dealt.select("group", F.spark_partition_id().alias("part")).distinct().collect()
        assert sorted(r.group for r in places) == sorted({r.part for r in places}) == list(range(groups))


def test_messages_of_tasks_are_small_and_exact():
    rng = np.random.default_rng(1)
    leaf = np.zeros((2, 3, 40, 256))
    leaf[:, :, :, rng.integers(0, 256, 60)] = rng.integers(-1 << 24, 1 << 24, 60)
    for numbers in (leaf, leaf * (1 << 20), np.zeros((3, 5)), np.array([-float(1 << 50), 1.0, 0.0]), np.array([float(1 << 31), -float(1 << 31)])):
        assert (trees.numbers_of(trees.message(numbers), numbers.shape) == numbers).all()
    assert len(trees.message(leaf)) < leaf.nbytes // 8


def test_a_forest_does_not_depend_on_its_parts(known, monkeypatch):
    """Rows in one array, or in several parts that a file holds."""
    forest, n = Forest(trees=4, depth=6, min_rows=5), len(known.cuts)
    bins, label = rows_of(known.blocks, n)
    whole = [trees.forest_tree(bins, label, forest, k) for k in range(4)]
    own = trees.Parts(n)
    monkeypatch.setattr(trees, "PART_ROWS", 150)
    for at in range(0, bins.shape[1], 100):
        own.add(bins[:, at:at + 100].tobytes(), label[at:at + 100].astype(np.uint8).tobytes())
    parts, flags = own.closed(), own.label()
    assert len(parts) > 5 and all(isinstance(p, np.memmap) for p in parts) and (flags == label).all()
    assert [t.plain() for t in whole] == [trees.forest_tree(parts, flags, forest, k).plain() for k in range(4)]


def test_features_counted_together_are_told_apart():
    """Few bins share a code, a row shares a double with its hessian: sums are those of the rows, also beyond one helping of rows."""
    rng = np.random.default_rng(3)
    sizes, n = (2, 3, 5, 250, 7, 1, 200), 250_000
    bins = np.stack([rng.integers(0, s, n) for s in sizes]).astype(np.uint8)
    gradient, hessian = rng.integers(-1 << 20, 1 << 20, n).astype(float), np.full(n, float(1 << 18))
    leaves = [trees.Leaf(np.arange(0, n, 2), np.zeros(3), 0), trees.Leaf(np.arange(1, n, 6), np.zeros(3), 0)]
    groups = trees.joined(bins)
    assert len(groups) < len(sizes) and sorted(f for g in groups for f in g.features) == list(range(len(sizes)))
    found = trees.histograms(len(sizes), groups, leaves, gradient, hessian + trees.ROW)
    for leaf, mine in zip(leaves, found):
        for f in range(len(sizes)):
            for got, weights in zip(mine, (gradient, hessian, np.ones(n))):
                assert (got[f] == np.bincount(bins[f][leaf.rows], weights[leaf.rows], minlength=256)).all()


def test_boosted_fits_run_side_by_side(lake):
    """All fits of one task are under way at once, and give what they give one by one."""
    from clickloom.plans import training
    small = {"boosted, histogram": {"rounds": 5}, "boosted, leafwise": {"rounds": 5, "patience": 2}, "boosted, depthwise": {"rounds": 5, "patience": 2}}
    meet, fits = Barrier(3), dict(training.FITS)
    training.FITS.update({n: lambda *a, fit=fits[n], **s: (meet.wait(60), fit(*a, **s))[1] for n in small})
    try:
        found = training.fit_all(lake.train, small, tuple(small))
    finally:
        training.FITS.update(fits)
    assert {n: m.trees for n, m in found.items()} == {n: fits[n](lake.train, models.Inputs(lake.train), **s).trees for n, s in small.items()}


@pytest.mark.parametrize("grow", [Growth(6, 0.3, 8, 4, 5), Growth(6, 0.3, 31, 100, 3, 0.5, 1.0)])
def test_processes_do_not_change_the_trees(known, grow, monkeypatch):
    n = len(known.cuts)
    one = trees.fitted_trees(known.blocks, n, -1.0, grow, tasks=1)
    monkeypatch.setattr(trees, "ROWS_PER_PROCESS", 1)
    assert trees.processes_of_a_task(known.blocks.sparkSession, 3) == 2 and trees.processes_of_a_task(known.blocks.sparkSession, 20) == 1
    assert one == trees.fitted_trees(known.blocks, n, -1.0, grow, tasks=1, beside=3) == trees.fitted_trees(known.blocks, n, -1.0, grow, tasks=1, segment=2)


def test_rows_are_led_through_a_tree_piece_by_piece(monkeypatch):
    """An uneven tree, more rows than a piece: against one row and one node at a time."""
    rng = np.random.default_rng(8)
    bins = rng.integers(0, 256, (4, 1000)).astype(np.uint8)
    gradient, hessian = np.rint(rng.standard_normal(1000) * trees.UNIT / 8), np.full(1000, trees.UNIT / 4)
    tree = trees.grow_tree(bins, np.arange(1000), gradient, hessian, Growth(1, 0.1, 40, 100), lambda x: x)

    def slow(row):
        node = 0
        while tree.feature[node] >= 0:
            node = tree.left[node] + int(bins[tree.feature[node], row] > tree.cut[node])
        return node

    monkeypatch.setattr(trees, "PIECE", 64)
    assert tree.leaves_of(bins).tolist() == [slow(row) for row in range(1000)]
    assert trees.Walk.of(tree).leaves_of(bins[:, :64].copy()).tolist() == [slow(row) for row in range(64)]
