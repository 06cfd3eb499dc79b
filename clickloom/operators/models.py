"""Classifiers on the Gold features: preparation, training, comparison and importance."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace
from functools import cached_property
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import Imputer, OneHotEncoder, OneHotEncoderModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from clickloom.constants import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES, RECALL_KS, SEED
from clickloom.operators.blockscore import Coded
from clickloom.operators.prefix import Timeline, pieces_of, quantile_splits, row_position
from clickloom.operators.ranking import PACKED, auc, auc_by_group, packed_scores, recall_at, true_ranks_of_rows
from clickloom.operators import newton, trees
from clickloom.operators.dictionaries import CategorySlots, CategorySlotsModel
from clickloom.operators.trees import Forest, Growth, Prepared, TreeModel
from clickloom.session import materialize

# Settings of the compared models.
FOREST = Forest(trees=300, depth=12, min_rows=5)
BOOSTED = {
    "histogram": Growth(rounds=300, step=0.05, leaves=31, depth=8, min_rows=20),
    "leafwise": Growth(rounds=3000, step=0.02, leaves=63, depth=1000, min_rows=30, min_hessian=1e-3, ridge=3.0),
    "depthwise": Growth(rounds=3000, step=0.03, leaves=64, depth=6, min_hessian=1.0, ridge=5.0, metric="auc"),
}
SETTINGS = {"numTrees": "trees", "maxIter": "rounds", "stepSize": "step", "maxDepth": "depth", "minInstancesPerNode": "min_rows"}
VALIDATION_SHARE = 0.15
PATIENCE = 100
ROWS_PER_TASK = 20_000    # trees run many short jobs; smaller tasks cost more to start than they take
ROWS_PER_ITERATION = 100_000    # some 60 MB of features
SCORES_PER_PART = 1_000_000     # of one swapped feature, which are ordered at once
# Missing where the ad is in no dimension; models read the train mean instead.
NULLABLE_NUMBERS = ["price", "user_price_gap"]
KNOWN = "_or_mean"


def filled(numeric: Sequence[str]) -> tuple[list, list[str]]:
    """A stage that fills missing numbers by their train mean, and the names that models then read."""
    missing = [c for c in numeric if c in NULLABLE_NUMBERS]
    stages = [Imputer(inputCols=missing, outputCols=[c + KNOWN for c in missing], strategy="mean")] if missing else []
    return stages, [c + KNOWN if c in missing else c for c in numeric]


def linear_stages(numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES) -> list:
    """Standardized numbers and one-hot categories; an unseen category is all zeros."""
    stages, read = filled(numeric)
    return [
        *stages,
        CategorySlots(categorical, [f"{c}_ix" for c in categorical]),
        # Unseen values have a slot beyond all others, which is dropped.
        OneHotEncoder(inputCols=[f"{c}_ix" for c in categorical], outputCols=[f"{c}_oh" for c in categorical], dropLast=True, handleInvalid="keep"),
        VectorAssembler(inputCols=read, outputCol="_numeric"),
        StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["_scaled", *[f"{c}_oh" for c in categorical]], outputCol="features"),
    ]


def logistic(rows: int, max_iter: int = 1000) -> LogisticRegression:
    """L2 with unit strength on the summed loss, which is 1/n on Spark's mean loss."""
    return LogisticRegression(
        labelCol="click", maxIter=max_iter, regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False, tol=1e-8,
    )


def packed(rows: DataFrame) -> DataFrame:
    """The rows in no more partitions than are worth a task."""
    return rows.coalesce(max(1, -(-rows.count() // ROWS_PER_TASK)))


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """Many rows in as many partitions as a shuffle has, or more where these would hold more than ``ROWS_PER_ITERATION``.

    A few files hold millions of rows, and a task keeps the features of its rows and reads them in every iteration.
    """
    return rows.repartition(max(pieces_of(rows), -(-n // ROWS_PER_ITERATION))) if n > pieces_of(rows) * ROWS_PER_TASK else rows


def changed(preset: Growth | Forest, **settings) -> Growth | Forest:
    """A preset with some of its settings changed; Spark's names of settings are understood too."""
    return replace(preset, **{SETTINGS.get(k, k): v for k, v in settings.items()})


def logistic_of(coefficients: np.ndarray, intercept: float, rows: int) -> LogisticRegressionModel:
    """A model of known weights: bounds that leave a fit no choice, on one row of zeros and one of ones."""
    two = SparkSession.active().createDataFrame([(Vectors.dense(np.full(len(coefficients), float(k))), k) for k in (0, 1)], ["features", "click"])
    weights, shift = Matrices.dense(1, len(coefficients), list(coefficients)), Vectors.dense([intercept])
    held = dict(lowerBoundsOnCoefficients=weights, upperBoundsOnCoefficients=weights, lowerBoundsOnIntercepts=shift, upperBoundsOnIntercepts=shift)
    return logistic(rows, 0).setParams(**held).fit(two)


def fit_logistic(train: DataFrame, max_iter: int = 1000) -> PipelineModel:
    """The features are made first, then dealt to the tasks that read them in every step."""
    made = Pipeline(stages=linear_stages()).fit(packed(train))
    rows, clicks = train.agg(F.count(F.lit(1)), F.sum("click")).first()
    featured = made.transform(packed(train))
    sizes = next(s for s in made.stages if isinstance(s, OneHotEncoderModel)).categorySizes
    if not 0 < clicks < rows or len(NUMERIC_FEATURES) + sum(sizes) > newton.MAX_FEATURES:
        return PipelineModel([*made.stages, logistic(rows, max_iter).fit(dealt(featured.select("features", "click"), rows))])
    slots = F.array(*[F.col(f"{c}_ix").cast("int") for c in CATEGORICAL_FEATURES])
    read = materialize(dealt(featured.select(vector_to_array("_scaled").alias("x"), slots.alias("slots"), "click"), rows), "linear-rows")
    coefficients, intercept, _ = newton.optimum(read, sizes, len(NUMERIC_FEATURES), math.log(clicks / (rows - clicks)), max_iter)
    return PipelineModel([*made.stages, logistic_of(coefficients, intercept, rows)])


def with_validation_flag(train: DataFrame, share: float = VALIDATION_SHARE) -> DataFrame:
    """Mark the last ``share`` of the train rows by time."""
    rows = train.withColumn("_us", F.unix_micros("time_stamp"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    placed = row_position(rows, ("_us", "event_id"), Timeline.of(rows))
    return placed.withColumn("is_validation", F.col("position") >= F.floor(total * F.lit(1 - share))).drop("position", "_us")


class Inputs:
    """The blocks of one train set, made once for all tree models, which may ask for them side by side."""

    def __init__(self, train: DataFrame):
        self.train, self.beside = train, 1      # how many fits run side by side
        self._made: dict[str, Prepared] = {}
        self._lock = Lock()      # one for all: to make two at a time takes twice the memory

    @cached_property
    def rows(self) -> int:
        return self.train.count()

    def _once(self, name: str, make: Callable[[], Prepared]) -> Prepared:
        with self._lock:
            if name not in self._made:
                self._made[name] = make()
            return self._made[name]

    @property
    def all_rows(self) -> Prepared:
        return self._once("all_rows", lambda: Prepared.of(self.train))

    @property
    def with_held(self) -> Prepared:
        return self._once("with_held", lambda: Prepared.of(materialize(with_validation_flag(self.train), "validation"), F.col("is_validation")))


def best_rounds(train: DataFrame, preset: str, patience: int = PATIENCE, inputs: Inputs | None = None, **settings) -> int:
    """The round that the last train rows by time like best, once ``patience`` more bring nothing."""
    inputs = inputs or Inputs(train)
    _, history = trees.search(inputs.with_held, changed(BOOSTED[preset], **settings), patience, beside=inputs.beside)
    return history.index(min(history)) + 1


def fit_boosted(
    train: DataFrame, preset: str = "histogram", early_stop: bool = False, patience: int = PATIENCE, inputs: Inputs | None = None, **settings,
) -> TreeModel:
    """Boosted trees; with ``early_stop`` their number is found on the last rows by time, then all rows are fitted."""
    inputs, grow = inputs or Inputs(train), changed(BOOSTED[preset], **settings)
    if early_stop:
        grow = replace(grow, rounds=best_rounds(train, preset, patience, inputs, **settings))
    return trees.fit(inputs.all_rows, grow, beside=inputs.beside)


def fit_forest(train: DataFrame, inputs: Inputs | None = None, **settings) -> TreeModel:
    return trees.fit_forest((inputs or Inputs(train)).all_rows, changed(FOREST, **settings))


def probability(name: str = "probability") -> Column:
    return vector_to_array(F.col(name))[1]


def scored(model: PipelineModel | TreeModel, rows: DataFrame, *keep: str) -> DataFrame:
    if isinstance(model, TreeModel):
        return model.scored(rows, *keep)
    return model.transform(rows).select(*keep, probability().alias("score"))


def evaluate(name: str, model: PipelineModel, test: DataFrame, candidates: DataFrame, ks: Sequence[int] = RECALL_KS) -> DataFrame:
    """One row: model, AUC on the test rows and recall@K on the candidate rows."""
    area = auc(scored(model, test, "event_id", "click"), "score")
    ranks = true_ranks_of_rows(scored(model, candidates, "query_id", "true_adgroup_id", "adgroup_id"))
    recall = recall_at(ranks, ks)
    columns = [c for c in recall.columns if c.startswith("recall")]
    return recall.select(F.lit(name).alias("model"), area.scalar().alias("auc"), *columns)


def comparison(rows: Sequence[DataFrame]) -> DataFrame:
    """Models by decreasing AUC."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.orderBy(F.desc("auc"), "model")


def winner(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("auc"), "model").limit(1)


def slots_of(model: PipelineModel) -> CategorySlotsModel:
    return next(s for s in model.stages if isinstance(s, CategorySlotsModel))


def feature_names(model: PipelineModel, rows: DataFrame) -> list[str]:
    """Names of the vector slots, from the metadata the feature stages leave."""
    vector = model.transform(rows.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    named = {a["idx"]: a["name"] for group in vector.values() for a in group}
    numeric = dict(enumerate(NUMERIC_FEATURES))
    names = [numeric.get(i, named[i]) if named[i].startswith("_scaled") else named[i] for i in range(len(named))]
    return [n.removesuffix(KNOWN) for n in names]


def importance(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Absolute coefficient or impurity gain of each vector slot, largest first."""
    if isinstance(model, TreeModel):
        return rows.sparkSession.createDataFrame(model.importance(), "feature string, importance double").orderBy(F.desc("importance"), "feature")
    last = model.stages[-1]
    weights = [abs(float(w)) for w in last.coefficients] if hasattr(last, "coefficients") else [float(w) for w in last.featureImportances.toArray()]
    pairs = rows.sparkSession.createDataFrame(list(zip(feature_names(model, rows), weights)), "feature string, importance double")
    one_hot = r"^(.*)_oh_(\d+)$"
    table = slots_of(model).table.select("column", "value", F.col("slot").cast("string").alias("slot"))
    named = pairs.withColumns({"column": F.regexp_extract("feature", one_hot, 1), "slot": F.regexp_extract("feature", one_hot, 2)}).join(table, ["column", "slot"], "left")
    shown = F.coalesce(F.concat("column", F.lit("_oh_"), "value"), "feature").alias("feature")
    return named.select(shown, "importance").orderBy(F.desc("importance"), "feature")


def with_places(test: DataFrame, seeds: Sequence[int]) -> DataFrame:
    """The rows, written with their ``position`` by id and their place by a hash for each seed (``_place0``, ``_place1``, ...).

    Places are found on hashes and positions alone; whole rows move once to be numbered and once to meet their places.
    """
    numbered = materialize(row_position(test, ("event_id", "event_id"), Timeline.of(test, "event_id", "event_id")), "numbered-test")
    out = numbered
    for k, seed in enumerate(seeds):
        hashed = numbered.select("position", F.abs(F.xxhash64(F.lit(seed), "event_id") % F.lit(1 << 40)).alias("_hash"))
        out = out.join(row_position(hashed, ("_hash", "position"), Timeline.of(hashed, "_hash", "position"), f"_place{k}").drop("_hash"), "position")
    return materialize(out, "placed-test")


def pairs_at(placed: DataFrame, k: int, columns: Sequence[str]) -> DataFrame:
    """Each row next to the features of the row whose place by the seed ``k`` is its position."""
    others = placed.select(F.col(f"_place{k}").alias("position"), *[F.col(c).alias(f"{c}_other") for c in columns])
    own = placed.drop(*[c for c in placed.columns if c.startswith("_place")])
    return own.join(others, "position").drop("position")


def shuffled_pairs(test: DataFrame, seed: int, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Each row next to the features of a random partner row, as ``<feature>_other``.

    Rows are numbered once by id and once by a seeded hash; equal numbers meet in one join.
    """
    return pairs_at(with_places(test, [seed]), 0, columns)


def swapped_scores(coded: Coded, columns: Sequence[str]) -> Callable[[pa.RecordBatch], Iterator[np.ndarray]]:
    """Of a batch (click, matrix, matrix of the partners) the scores as it is and with each of the ``columns`` from the partner."""
    (score,), width = coded.scorers().values(), len(coded.columns)
    own = [[k for k, c in enumerate(coded.columns) if coded.feature_of(c) == f] for f in columns]

    def run(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        values, others = trees.matrix_of(batch, 1, width), trees.matrix_of(batch, 1 + width, width)
        for swapped in [[], *own]:
            kept = values[swapped]
            values[swapped] = others[swapped]
            yield score(values)
            values[swapped] = kept

    return run


def matrices(coded: Coded, pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("click").cast("int").alias("click"), *coded.columns, *[f"{c}_other" for c in coded.columns])


def with_swaps(coded: Coded, pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(_variant, click, score): every row as it is (0) and with each of the ``columns`` (1, 2, ...) taken from its partner."""
    scores = swapped_scores(coded, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, found in enumerate(scores(batch)):
                yield pa.record_batch([pa.array(np.full(batch.num_rows, at)), batch.column(0), pa.array(found)], names=["_variant", "click", "score"])

    return matrices(coded, pairs).mapInArrow(run, "_variant bigint, click int, score double")


def packed_swaps(coded: Coded, pairs: DataFrame, columns: Sequence[str], borders: Sequence[float], first: int) -> DataFrame:
    """The same scores for ``auc_by_group``, variants numbered from ``first`` on: a row per batch, variant and part of the scores."""
    scores, inner = swapped_scores(coded, columns), np.asarray(borders[1:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            click = batch.column(0).to_numpy(zero_copy_only=False) == 1
            for at, found in enumerate(scores(batch)):
                yield packed_scores(first + at, found, click, inner)

    return matrices(coded, pairs).mapInArrow(run, PACKED)


def score_borders(coded: Coded, rows: DataFrame) -> list[float]:
    """Borders between parts of the scores of the rows as they are; areas do not depend on them."""
    (score,), pieces = coded.scorers().values(), -(-rows.count() // SCORES_PER_PART)
    if pieces < 2:
        return [-math.inf, math.inf]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(score(trees.matrix_of(batch, 0, batch.num_columns)))], names=["score"])

    return quantile_splits(rows.select(*coded.columns).mapInArrow(run, "score double"), ["score"], pieces)["score"]


def permutation_importance(model: PipelineModel | TreeModel, test: DataFrame, repeats: int = 5, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Mean drop of the AUC when one feature takes the values of random partner rows.

    Rows are coded once; as they are and once per swapped feature they are scored as matrices, and all areas come from one pass.
    """
    coded, variants = Coded({"model": model}), len(columns) + 1
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c)
    rows = coded.coded(test, CATEGORICAL_FEATURES).select("event_id", "click", *map(number, coded.columns))
    placed, scores = with_places(materialize(rows, "coded-test"), [SEED + r for r in range(repeats)]), None
    borders = score_borders(coded, placed)
    for r in range(repeats):
        found = packed_swaps(coded, pairs_at(placed, r, coded.columns), columns, borders, r * variants)
        scores = found if scores is None else scores.unionByName(found)
    areas = materialize(auc_by_group(scores), "swapped-areas")
    at = F.pmod("feature", F.lit(variants)).cast("int")
    areas = areas.select(F.floor(F.col("feature") / variants).alias("_repeat"), at.alias("_at"), "auc")
    base = F.max(F.when(F.col("_at") == 0, F.col("auc"))).over(W.partitionBy("_repeat"))
    drops = areas.withColumn("drop", base - F.col("auc")).where("_at > 0")
    named = F.element_at(F.array(*map(F.lit, columns)), F.col("_at")).alias("feature")
    return drops.groupBy(named).agg(F.avg("drop").alias("importance")).orderBy(F.desc("importance"), "feature")


def save_bundle(model: PipelineModel, name: str, path: str) -> None:
    """The fitted pipeline with a JSON record of what it was trained on."""
    model.save(f"{path}/model") if isinstance(model, TreeModel) else model.write().overwrite().save(f"{path}/model")
    record = {"model_name": name, "kind": type(model).__name__, "categorical_features": CATEGORICAL_FEATURES, "numeric_features": NUMERIC_FEATURES}
    SparkSession.active().createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/features")


def load_bundle(path: str) -> tuple[PipelineModel | TreeModel, dict]:
    record = json.loads(SparkSession.active().read.text(f"{path}/features").first()[0])
    kind = TreeModel if record.get("kind") == TreeModel.__name__ else PipelineModel
    return kind.load(f"{path}/model"), record
