"""From Gold to recommendations: compare models, keep the winner, describe it and let it rank the catalog."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators import blockscore, models, ranking, trees
from clickloom.operators.blockscore import Coded
from clickloom.operators.candidates import (
    Lookups, catalog_of, click_queries, lookups_of, popularity_score, user_snapshot,
)
from clickloom.operators.encode import is_train
from clickloom.operators.trees import TreeModel
from clickloom.session import materialize

Model = PipelineModel | TreeModel
Fit = Callable[..., Model]

# The five compared models; keyword settings override the presets, ``inputs`` are shared by all tree models.
FITS: dict[str, Fit] = {
    "logistic": lambda train, inputs, **s: models.fit_logistic(train, **s),
    "forest": lambda train, inputs, **s: models.fit_forest(train, inputs, **s),
    "boosted, histogram": lambda train, inputs, **s: models.fit_boosted(train, "histogram", inputs=inputs, **s),
    "boosted, leafwise": lambda train, inputs, **s: models.fit_boosted(train, "leafwise", early_stop=True, inputs=inputs, **s),
    "boosted, depthwise": lambda train, inputs, **s: models.fit_boosted(train, "depthwise", early_stop=True, inputs=inputs, **s),
}


def fit_all(
    train: DataFrame, settings: Mapping[str, Mapping] | None = None, names: Sequence[str] = tuple(FITS), inputs: models.Inputs | None = None,
) -> dict[str, Model]:
    """The fitted models. Boosted fits of few rows run side by side, and beside the others; larger ones take all cores."""
    settings, inputs = settings or {}, inputs or models.Inputs(train)
    fit = lambda name: FITS[name](train, inputs, **settings.get(name, {}))
    beside = [n for n in names if n.startswith("boosted")] if inputs.rows <= trees.ROWS_BESIDE else []
    inputs.beside = max(1, len(beside))
    with ThreadPoolExecutor(inputs.beside) as pool:
        begun = {n: pool.submit(inheritable_thread_target(train.sparkSession)(fit), n) for n in beside}
        for b in begun.values():
            b.add_done_callback(lambda _: setattr(inputs, "beside", max(1, sum(not f.done() for f in begun.values()))))
        done = {n: fit(n) for n in names if n not in begun}
        return {n: begun[n].result() if n in begun else done[n] for n in names}


def floors(test: DataFrame, lookups: Lookups, queries: DataFrame) -> list[DataFrame]:
    """The rows of the popularity and random baselines."""
    found = []
    for name, score, area in (
        ("popularity", popularity_score, ranking.auc(test, "ag_ctr_before").scalar()), ("random", ranking.random_score(), F.lit(0.5)),
    ):
        recall = ranking.recall_at(ranking.true_ranks(queries, lookups, score)).drop("queries")
        found.append(recall.select(F.lit(name).alias("model"), area.alias("auc"), *recall.columns))
    return found


def compared(fitted: Mapping[str, Model], gold: DataFrame, lookups: Lookups) -> DataFrame:
    """AUC and recall of all models and both floors, best first. The models score the test rows and the candidates together."""
    test, queries, coded = gold.where(~is_train()), click_queries(gold), Coded(fitted)
    rows = blockscore.areas(coded, test).join(blockscore.recalls(coded, queries, lookups), "model")
    return models.comparison([rows, *floors(test, lookups, queries)])


def recommend(model: Model, gold: DataFrame, lookups: Lookups, users: DataFrame, size: int = 100) -> DataFrame:
    """The ``size`` best ads of each user by the model's score."""
    best = blockscore.best_of_model(Coded({"model": model}), user_snapshot(gold, users), lookups, "userid", size)
    return ranking.recommendations(best, size=size)


def train(
    spark: SparkSession, lake: str, settings: Mapping[str, Mapping] | None = None, names: Sequence[str] = tuple(FITS),
    sample_users: int | None = None, repeats: int = 5,
) -> str:
    """Train on Gold and write the comparison, the winner's lift, bundle, importances and recommendations as JSON.

    All test users get recommendations unless ``sample_users`` asks for a reproducible sample.
    """
    out = f"{lake}/train"
    gold = spark.read.parquet(f"{lake}/gold/training_features.parquet")
    known, test = gold.where(is_train()), gold.where(~is_train())
    lookups = lookups_of(gold, materialize(catalog_of(gold), "catalog"))
    fitted = fit_all(known, settings, names)
    table = materialize(compared(fitted, gold, lookups), "comparison")
    table.write.mode("overwrite").parquet(f"{out}/comparison.parquet")
    name = models.winner(table.where(F.col("model").isin(*fitted))).first()["model"]
    best = fitted[name]
    ranking.lift_table(models.scored(best, test, "event_id", "click"), "score").write.mode("overwrite").parquet(f"{out}/lift.parquet")
    models.save_bundle(best, name, f"{out}/bundle")
    models.importance(best, known).write.mode("overwrite").parquet(f"{out}/importance.parquet")
    models.permutation_importance(best, test, repeats).write.mode("overwrite").parquet(f"{out}/permutation_importance.parquet")
    users = test.select(F.col("userid_key").alias("userid")).distinct()
    users = users if sample_users is None else ranking.sampled_users(users, sample_users)
    ranking.write_recommendations(recommend(best, gold, lookups, users), f"{out}/recommendations.json")
    return out
