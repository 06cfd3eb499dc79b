"""Model preparation, training, comparison, importance and the saved bundle."""

import pytest
from pyspark.sql import functions as F

from clickloom.constants import FEATURES, NUMERIC_FEATURES
from clickloom.operators import models, ranking
from clickloom.operators.candidates import click_queries, exploded, with_candidates
from clickloom.operators.encode import is_train
from clickloom.plans.lake import Lake


@pytest.fixture(scope="module")
def lake(spark):
    return Lake.at(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def split(lake):
    return lake.gold.where(is_train()).cache(), lake.gold.where(~is_train()).cache()


@pytest.fixture(scope="module")
def logistic(split):
    return models.fit_logistic(split[0], 30)


def test_unseen_categories_are_all_zero(spark):
    from pyspark.ml import Pipeline
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "brand string, price double")
    test = spark.createDataFrame([("zz", 1.0), ("b", 1.0)], "brand string, price double")
    model = Pipeline(stages=models.linear_stages(["price"], ["brand"])).fit(train)
    got = [r.features.toArray().tolist() for r in model.transform(test).collect()]
    assert got[0][1:] == [0.0, 0.0] and got[1][1:] == [0.0, 1.0]


def test_slots_of_many_brands_come_from_a_table(spark):
    """200,000 values: slots by frequency, then by value; unseen and null ones have the slot beyond."""
    from clickloom.operators.dictionaries import CategorySlots
    rows = spark.range(300_000).select(F.concat(F.lit("b"), F.format_string("%06d", F.col("id") % 200_000)).alias("brand"))
    model = CategorySlots(["brand"], ["brand_ix"]).fit(rows)
    asked = spark.createDataFrame([("b000000",), ("b000007",), ("b099999",), ("b100000",), ("b199999",), ("new",), (None,)], "brand string")
    got = {r.brand: r.brand_ix for r in model.transform(asked).collect()}
    assert got == {"b000000": 0, "b000007": 7, "b099999": 99_999, "b100000": 100_000, "b199999": 199_999, "new": 200_000, None: 200_000}


def test_rows_of_a_long_fit_are_dealt_to_many_tasks(spark):
    """Few files of many rows: no task keeps more than a bounded number; short logs stay as they are."""
    rows = spark.range(0, 1_000_000, 1, 2)
    tasks = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    sizes = tasks(models.dealt(rows, 1_000_000))
    assert max(sizes) <= 1.1 * models.ROWS_PER_ITERATION and sum(sizes) == 1_000_000
    assert len(tasks(models.dealt(spark.range(0, 10_000, 1, 2), 10_000))) == 2


def test_validation_rows_are_the_last_ones(split):
    rows = models.with_validation_flag(split[0]).groupBy("is_validation").agg(
        F.count("*").alias("n"), F.min("time_stamp").alias("lo"), F.max("time_stamp").alias("hi")).collect()
    got = {r.is_validation: r for r in rows}
    total = got[True].n + got[False].n
    assert got[False].n == int(total * 0.85) and got[False].hi <= got[True].lo


def test_early_stopping_keeps_the_trees_that_help(spark, split):
    """A clear signal that small steps approach slowly keeps more than a handful of trees; noise keeps few."""
    rows = split[0].withColumn("click", ((F.col("event_id") * 37 % 100) / 100 < F.when(F.col("event_id") % 2 == 0, 0.9).otherwise(0.1)).cast("int"))
    rows = rows.withColumn("price", (F.col("event_id") % 2).cast("double"))
    signal = models.best_rounds(rows, "depthwise", patience=5, maxIter=40, maxDepth=2, metric="loss")
    noise = models.best_rounds(split[0].withColumn("click", (F.xxhash64("event_id") % 2 == 0).cast("int")), "histogram", patience=3, maxIter=12, maxDepth=5, stepSize=0.5)
    assert signal > 15 and noise < signal


def test_a_missing_price_is_read_as_the_train_mean(split):
    train, test = (df.withColumn("price", F.when(F.col("event_id") % 5 > 0, F.col("price"))) for df in split)
    assert models.scored(models.fit_logistic(train, 5), test, "event_id").where("score IS NULL").count() == 0


def test_evaluation_and_winner(lake, split, logistic):
    candidates = exploded(with_candidates(click_queries(lake.gold), lake.lookups))
    assert set(FEATURES) <= set(candidates.columns)
    row = models.evaluate("logistic", logistic, split[1], candidates)
    other = row.withColumns({"model": F.lit("none"), "auc": F.lit(0.0)})
    table = models.comparison([other, row]).collect()
    assert [r.model for r in table] == ["logistic", "none"]
    assert 0 <= table[0].recall_at_10 <= table[0].recall_at_100 <= 1
    assert models.winner(models.comparison([other, row])).collect()[0].model == "logistic"


def test_importance_names_every_slot(split, logistic):
    rows = models.importance(logistic, split[0]).collect()
    assert len(rows) == len(logistic.stages[-1].coefficients)
    assert set(NUMERIC_FEATURES) <= {r.feature for r in rows}


def test_permutation_importance_finds_the_only_signal(spark, split):
    train, test = (df.withColumn("price", F.col("click") * 2.0 + F.col("event_id") % 2) for df in split)
    model = models.fit_logistic(train, 30)
    rows = models.permutation_importance(model, test, repeats=2, columns=["price", "ag_ctr_before"]).collect()
    assert rows[0].feature == "price" and rows[0].importance > 0.2


def test_shuffled_pairs_is_a_permutation(split):
    pairs = models.shuffled_pairs(split[1], 1, ["price", "hour"]).select("event_id", "hour", "hour_other").collect()
    assert len(pairs) == split[1].count()
    assert sorted(r.hour for r in pairs) == sorted(r.hour_other for r in pairs)
    assert any(r.hour != r.hour_other for r in pairs)


def test_bundle_round_trip(tmp_path, split, logistic):
    models.save_bundle(logistic, "logistic", str(tmp_path / "bundle"))
    model, record = models.load_bundle(str(tmp_path / "bundle"))
    assert record["model_name"] == "logistic" and record["numeric_features"] == NUMERIC_FEATURES
    score = lambda m: [round(r.score, 9) for r in models.scored(m, split[1].orderBy("event_id").limit(20), "event_id").orderBy("event_id").collect()]
    assert score(model) == score(logistic)


def test_random_score_is_repeatable_and_uniform(spark, lake):
    arrays = with_candidates(click_queries(lake.gold), lake.lookups)
    from clickloom.operators.candidates import with_scores
    rows = with_scores(arrays, ranking.random_score()).select(F.explode("scored.score").alias("s")).agg(F.avg("s"), F.min("s"), F.max("s")).first()
    assert abs(rows[0] - 0.5) < 0.05 and rows[1] >= 0 and rows[2] < 1


def test_swapped_rows_score_as_the_model_scores_them(logistic, split):
    """The coded matrix of a swapped feature against the model on rows that carry the partner's value."""
    from clickloom.operators.blockscore import Coded
    test, swapped = split[1], ["price", "brand"]
    coded = Coded({"model": logistic})
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c)
    rows = coded.coded(test, models.CATEGORICAL_FEATURES).select("event_id", "click", *map(number, coded.columns))
    got = models.with_swaps(coded, models.shuffled_pairs(rows, models.SEED, coded.columns), swapped).collect()
    pairs = models.shuffled_pairs(test, models.SEED)
    for at, feature in enumerate(["", *swapped]):
        plain = pairs.withColumn(feature, F.col(f"{feature}_other")) if feature else pairs
        slow = sorted(r.score for r in models.scored(logistic, plain).collect())
        fast = sorted(r.score for r in got if r._variant == at)
        assert fast == pytest.approx(slow, abs=1e-9)


def test_a_dozen_steps_reach_the_optimum_of_the_logistic_loss(split):
    """Slopes of the penalised sum vanish at every weight; gradient steps need hundreds of passes for that."""
    import numpy as np
    model = models.fit_logistic(split[0], 12)
    last, rows = model.stages[-1], model.transform(split[0]).select("features", "click", models.probability().alias("p")).collect()
    matrix = np.array([r.features.toArray() for r in rows])
    error = np.array([r.p - r.click for r in rows])
    assert abs(matrix.T @ error + last.coefficients.toArray()).max() < 1e-5 and abs(error.sum()) < 1e-5
    assert last.getRegParam() == 1 / len(rows) and len(last.coefficients) == matrix.shape[1]


def test_sums_of_the_logistic_fit_against_all_rows(spark):
    import numpy as np
    from clickloom.operators import newton
    data = [([0.1 * i, -1.0], [i % 3, i % 2], int(i * 7 % 5 < 2)) for i in range(60)]       # slot 2 of the first category is beyond
    rows, weights = spark.createDataFrame(data, "x array<double>, slots array<int>, click int").repartition(3), np.linspace(-1, 1, 7)
    loss, slope, curve = newton.sums_at(rows, [2, 2], 2, weights)
    matrix = np.array([[*x, s[0] == 0, s[0] == 1, s[1] == 0, s[1] == 1, 1] for x, s, _ in data], float)
    click, chance = np.array([c for *_, c in data]), 1 / (1 + np.exp(-matrix @ weights))
    assert loss == pytest.approx(-(click * np.log(chance) + (1 - click) * np.log(1 - chance)).sum())
    assert slope == pytest.approx(matrix.T @ (chance - click)) and curve == pytest.approx(matrix.T @ (matrix * (chance * (1 - chance))[:, None]))


def test_boosted_trees_are_fitted_on_all_rows(spark, split, monkeypatch):
    """However many rows there are: the count of a huge train set must not make a fit leave some out."""
    from pyspark.sql.classic.dataframe import DataFrame
    rows = split[0].count()
    monkeypatch.setattr(DataFrame, "count", lambda self: 400_000_000)
    inputs = models.Inputs(split[0])
    monkeypatch.undo()
    assert inputs.all_rows.blocks.agg(F.sum("rows")).first()[0] == rows


def test_a_forest_is_fitted_on_all_rows(spark, split, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    rows, seen = split[0].count(), []
    monkeypatch.setattr(models.trees, "fit_forest", lambda known, *_: seen.append(known))
    monkeypatch.setattr(DataFrame, "count", lambda self: 16_000_000)
    models.fit_forest(split[0])
    assert seen[0].blocks.agg(F.sum("rows")).first()[0] == rows


def test_areas_of_packed_scores_are_those_of_pairs(spark):
    """Parts and ties: against all pairs; borders between the scores change nothing."""
    import numpy as np
    rng = np.random.default_rng(4)
    groups = {g: (np.round(rng.random(300), 2), rng.random(300) < 0.3) for g in (0, 7)} | {9: (np.full(40, 0.5), np.arange(40) % 2 == 0)}
    slow = {g: np.mean([(a > b) + (a == b) / 2 for a in s[c] for b in s[~c]]) for g, (s, c) in groups.items()}
    for borders in ([], [0.25, 0.5, 0.75], [0.5, 0.5000001]):
        batches = [ranking.packed_scores(g, s[k::3], c[k::3], np.array(borders)) for g, (s, c) in groups.items() for k in range(3)]
        packed = spark.createDataFrame([tuple(r.values()) for b in batches for r in b.to_pylist()], ranking.PACKED)
        assert {r.feature: r.auc for r in ranking.auc_by_group(packed).collect()} == pytest.approx(slow)


def test_partners_do_not_depend_on_how_many_shuffles_are_made(split):
    """Whole rows are numbered once for all seeds; partners are those of one shuffle at a time."""
    columns = ["price", "hour"]
    placed = models.with_places(split[1].select("event_id", *columns), [3, 8])
    for k, seed in enumerate([3, 8]):
        shown = lambda df: sorted(tuple(r) for r in df.select("event_id", "hour", "hour_other").collect())
        assert shown(models.pairs_at(placed, k, columns)) == shown(models.shuffled_pairs(split[1], seed, columns))


def test_scores_are_not_written_row_by_row(split, logistic, monkeypatch):
    """A row per batch and variant leaves the tasks that score, not one per score."""
    from clickloom.operators.blockscore import Coded
    coded, test = Coded({"model": logistic}), split[1]
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c)
    rows = coded.coded(test, models.CATEGORICAL_FEATURES).select("event_id", "click", *map(number, coded.columns))
    pairs = models.shuffled_pairs(rows, models.SEED, coded.columns).coalesce(1)
    packed = models.packed_swaps(coded, pairs, ["price", "brand"], models.score_borders(coded, rows), 0)
    assert packed.count() <= 6 and packed.agg(F.sum(F.length("clicks") + F.length("others"))).first()[0] == 3 * 8 * rows.count()
