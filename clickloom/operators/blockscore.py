"""Models that score whole blocks of candidates, all of them in one pass.

A query meets the catalog block by block as an array; no row per query and ad exists. Categories are coded before: what a
model needs of a category (its click rate, the sum of its coefficients) is joined to the queries and to the catalog once,
so that a block is a matrix of numbers, which one Arrow call per batch gives to every model. A first pass reads only the
query's own ad, a second counts the ads ahead of it, for all models at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickloom.constants import AD_DYNAMIC, CATEGORICAL_FEATURES, CATEGORY_DYNAMIC, NUMERIC_FEATURES, RECALL_KS
from clickloom.operators.candidates import Lookups, with_candidates
from clickloom.operators.ranking import auc_of
from clickloom.operators.trees import RATE, TreeModel, with_category
from clickloom.session import materialize

AD_CATEGORIES = ["cate_id", "brand"]
QUERY_CATEGORIES = [c for c in CATEGORICAL_FEATURES if c not in AD_CATEGORIES]
CROSS = [
    "pid_x_cate_id_freq", "cate_id_x_age_level_freq", "brand_x_cms_group_id_freq", "item_coclick_affinity",
    "user_cate_affinity_before", "user_brand_affinity_before", "user_price_gap",
]
AD_NUMBERS = ["price", *AD_DYNAMIC, *CATEGORY_DYNAMIC, *CROSS]
QUERY_NUMBERS = [c for c in NUMERIC_FEATURES if c not in AD_NUMBERS]
WEIGHT = "_weight"

Matrix = np.ndarray


def linear_parts(model: PipelineModel) -> tuple[dict[str, tuple[float, float, float]], DataFrame, float]:
    """Of a fitted logistic pipeline: (mean, deviation, weight) per number, a table of weights per category, the intercept."""
    by_type = {type(s).__name__: s for s in model.stages}
    scaler, slots, last = by_type["StandardScalerModel"], by_type["CategorySlotsModel"], model.stages[-1]
    n, weights = len(NUMERIC_FEATURES), [float(w) for w in last.coefficients]
    numbers = {c: (float(scaler.mean[i]), float(scaler.std[i]), weights[i]) for i, c in enumerate(NUMERIC_FEATURES)}
    at, of_slots = n, []
    for c in CATEGORICAL_FEATURES:
        of_slots += [(c, k, w) for k, w in enumerate(weights[at:at + slots.sizes[c]])]
        at += slots.sizes[c]
    known = slots.table.sparkSession.createDataFrame(of_slots, "column string, slot bigint, weight double")
    return numbers, materialize(slots.table.join(known, ["column", "slot"]).select("column", "value", "weight"), "weights"), float(last.intercept)


class Coded:
    """Several fitted models that read one matrix: numbers, click rates of categories, and weights of categories."""

    def __init__(self, models: Mapping[str, PipelineModel | TreeModel]):
        self.models = dict(models)
        self.trees = {n: m for n, m in self.models.items() if isinstance(m, TreeModel)}
        self.linear = {n: m for n, m in self.models.items() if n not in self.trees}
        if len({id(m.categories) for m in self.trees.values()}) > 1:
            raise ValueError("the tree models must be fitted on the same inputs")
        self.rates = [c + RATE for c in CATEGORICAL_FEATURES] if self.trees else []
        self.weights = [f"{c}{WEIGHT}{k}" for k, _ in enumerate(self.linear) for c in CATEGORICAL_FEATURES]
        self.columns = [*NUMERIC_FEATURES, *self.rates, *self.weights]
        self.parts = {n: linear_parts(m) for n, m in self.linear.items()}

    def coded(self, rows: DataFrame, categories: Sequence[str]) -> DataFrame:
        """The rows with the codes of these category columns."""
        for model in [*self.trees.values()][:1]:
            rows = with_category(rows, model.categories, "rate", categories, RATE, model.prior)
        for k, (_, weights, _) in enumerate(self.parts.values()):
            rows = with_category(rows, weights, "weight", categories, f"{WEIGHT}{k}", 0.0)
        return rows

    @staticmethod
    def feature_of(column: str) -> str:
        """The feature that a column of the matrix codes."""
        return column.removesuffix(RATE).split(WEIGHT)[0]

    def scorers(self) -> dict[str, Callable[[Matrix], np.ndarray]]:
        """Per model the probabilities of a matrix (columns, rows)."""
        place = {c: i for i, c in enumerate(self.columns)}

        def linear(k: int, numbers: dict, intercept: float) -> Callable[[Matrix], np.ndarray]:
            mean, spread, weight = (np.array([numbers[c][j] for c in NUMERIC_FEATURES])[:, None] for j in range(3))
            own = [place[f"{c}{WEIGHT}{k}"] for c in CATEGORICAL_FEATURES]

            def score(values: Matrix) -> np.ndarray:
                x = values[:len(NUMERIC_FEATURES)]
                scaled = np.where(np.isnan(x), 0.0, (x - mean) / np.where(spread == 0, np.inf, spread))
                return 1 / (1 + np.exp(-(intercept + (scaled * weight).sum(axis=0) + values[own].sum(axis=0))))

            return score

        def forest(model: TreeModel) -> Callable[[Matrix], np.ndarray]:
            score, own = model.scorer(), [place[c] for c in model.columns]
            return lambda values: score(values[own])

        found = {n: linear(k, numbers, intercept) for k, (n, (numbers, _, intercept)) in enumerate(self.parts.items())}
        found |= {n: forest(m) for n, m in self.trees.items()}
        return {n: found[n] for n in self.models}


def scored_rows(coded: Coded, rows: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and ``scores``, one number per model, in one pass."""
    scorers, n, columns = list(coded.scorers().values()), len(keep), coded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([batch.column(n + k).to_numpy(zero_copy_only=False) for k in range(len(columns))])
            scores = np.stack([s(values) for s in scorers], axis=1)
            ends = pa.array(np.arange(len(scores) + 1, dtype=np.int32) * len(scorers))
            yield pa.record_batch([*[batch.column(k) for k in range(n)], pa.ListArray.from_arrays(ends, pa.array(scores.ravel()))], names=[*keep, "scores"])

    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"_x_{c}")
    chosen = coded.coded(rows, CATEGORICAL_FEATURES).select(*keep, *[number(c) for c in columns])
    return chosen.mapInArrow(run, chosen.select(*keep).schema.add("scores", T.ArrayType(T.DoubleType())))


def areas(coded: Coded, test: DataFrame) -> DataFrame:
    """(model, auc) of every model on the test rows, which are scored once."""
    names = list(coded.models)
    rows = scored_rows(coded, test, "click").select("click", *[F.get("scores", k).alias(f"s{k}") for k in range(len(names))])
    found = auc_of(materialize(rows, "scores"), [f"s{k}" for k in range(len(names))])
    return found.select(F.element_at(F.array(*map(F.lit, names)), F.substring("feature", 2, 9).cast("int") + 1).alias("model"), "auc")


def coded_lookups(coded: Coded, lookups: Lookups) -> Lookups:
    """The same blocks with the codes of each ad's categories."""
    full = coded.coded(lookups.blocks.select("block", F.inline("ads")), AD_CATEGORIES)
    ads = full.groupBy("block").agg(F.collect_list(F.struct(*[c for c in full.columns if c != "block"])).alias("ads"))
    return replace(lookups, blocks=materialize(lookups.blocks.drop("ads").join(ads, "block"), "coded-blocks"))


Judge = Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], list[pa.Array]]


def over_blocks(coded: Coded, pairs: DataFrame, keep: Sequence[str], judge: Judge, result: str) -> DataFrame:
    """Score the candidates of every row by all models; ``judge`` makes of a batch, the scores (models, ads), the ads and the row
    of each ad the columns ``result``, which follow the first of the kept ones."""
    ad_codes = [c for c in coded.columns if coded.feature_of(c) in AD_CATEGORIES]
    in_ad = [*AD_NUMBERS, *ad_codes]
    in_query = [c for c in coded.columns if c not in in_ad]
    scorers, columns = list(coded.scorers().values()), coded.columns
    names = [keep[0], *[r.split()[0] for r in result.split(", ")]]
    number = lambda x: F.coalesce(x.cast("double"), F.lit(float("nan")))

    def candidate(ad: Column) -> Column:
        return F.struct(ad["adgroup_id"].cast("bigint").alias("adgroup_id"), *[number(ad[c]).alias(f"a{k}") for k, c in enumerate(in_ad)])

    chosen = pairs.select(*keep, F.transform("candidates", candidate).alias("_ads"), *[number(F.col(c)).alias(f"_q{k}") for k, c in enumerate(in_query)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ads = batch.column("_ads")
            ends = ads.offsets.to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            flat = ads.values.slice(ends[0], ends[-1] - ends[0])
            of = {c: flat.field(f"a{k}").to_numpy(zero_copy_only=False) for k, c in enumerate(in_ad)}
            of |= {c: batch.column(f"_q{k}").to_numpy(zero_copy_only=False)[row] for k, c in enumerate(in_query)}
            scores = np.stack([s(np.stack([of[c] for c in columns])) for s in scorers])
            found = judge(batch, scores, flat.field("adgroup_id").to_numpy(zero_copy_only=False), row)
            yield pa.record_batch([batch.column(keep[0]), *found], names=names)

    return chosen.mapInArrow(run, f"{keep[0]} {chosen.schema[keep[0]].dataType.simpleString()}, {result}")


def own_scores(batch: pa.RecordBatch, scores: np.ndarray, ad: np.ndarray, row: np.ndarray) -> list[pa.Array]:
    """The scores of the query's own ad, null where the block lacks it."""
    hit = np.flatnonzero(ad == batch.column("true_adgroup_id").to_numpy(zero_copy_only=False)[row])
    mine: list[list[float] | None] = [None] * batch.num_rows
    for at in hit:
        mine[row[at]] = scores[:, at].tolist()
    return [pa.array(mine, pa.list_(pa.float64()))]


def ads_ahead(batch: pa.RecordBatch, scores: np.ndarray, ad: np.ndarray, row: np.ndarray) -> list[pa.Array]:
    """How many ads of the block are ahead of the own one, per model, and the size of the block."""
    mine = np.array([m if m is not None else [np.nan] * len(scores) for m in batch.column("mine").to_pylist()], float).reshape(-1, len(scores))[row].T
    own = batch.column("true_adgroup_id").to_numpy(zero_copy_only=False)[row]
    ahead = (scores > mine) | ((scores == mine) & (ad < own))
    counts = np.stack([np.bincount(row, a, minlength=batch.num_rows) for a in ahead], axis=1).astype(np.int64)
    return [pa.array(counts.tolist(), pa.list_(pa.int64())), pa.array(np.bincount(row, minlength=batch.num_rows))]


def best_ads(size: int) -> Judge:
    """The best ads of the block by the first model, best first."""
    def judge(batch: pa.RecordBatch, scores: np.ndarray, ad: np.ndarray, row: np.ndarray) -> list[pa.Array]:
        order = np.lexsort((ad, -scores[0], row))
        place = np.arange(len(order)) - np.searchsorted(row, np.arange(batch.num_rows))[row]
        kept = order[place < size]
        ends = np.r_[0, np.cumsum(np.bincount(row[kept], minlength=batch.num_rows))].astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(scores[0][kept]), pa.array(ad[kept])], names=["score", "adgroup_id"])
        return [pa.ListArray.from_arrays(pa.array(ends), pairs)]

    return judge


def best_of_model(coded: Coded, queries: DataFrame, lookups: Lookups, key: str, size: int) -> DataFrame:
    """(key, scored): the best ads of each block by the first model, to be merged by ``ranking.recommendations``."""
    asked = coded.coded(queries, QUERY_CATEGORIES)
    pairs = with_candidates(asked, coded_lookups(coded, lookups))
    return over_blocks(coded, pairs, [key], best_ads(size), "scored array<struct<score:double,adgroup_id:bigint>>")


def recalls(coded: Coded, queries: DataFrame, lookups: Lookups, ks: Sequence[int] = RECALL_KS) -> DataFrame:
    """(model, recall_at_<k> ...) of every model: two passes over the candidates, whatever the number of models."""
    names, blocks = list(coded.models), coded_lookups(coded, lookups)
    asked = materialize(coded.coded(queries, QUERY_CATEGORIES), "coded-queries")
    own = over_blocks(coded, with_candidates(asked, blocks, own_ad_only=True), ["query_id", "true_adgroup_id"], own_scores, "mine array<double>")
    own = materialize(own.where("mine IS NOT NULL"), "own-scores")
    known = asked.join(own, "query_id", "left")
    counts = over_blocks(coded, with_candidates(known, blocks), ["query_id", "true_adgroup_id", "mine"], ads_ahead, "ahead array<bigint>, size bigint")
    counts = counts.select("query_id", "size", F.posexplode("ahead").alias("at", "ahead")).groupBy("query_id", "at").agg(F.sum("ahead").alias("ahead"), F.sum("size").alias("size"))
    ranks = counts.join(own.select("query_id").withColumn("_known", F.lit(True)), "query_id", "left")
    rank = F.when(F.col("_known"), F.col("ahead")).otherwise(F.col("size"))
    out = ranks.groupBy("at").agg(*[F.avg((rank < k).cast("int")).alias(f"recall_at_{k}") for k in ks])
    return out.select(F.element_at(F.array(*map(F.lit, names)), F.col("at") + 1).alias("model"), *[f"recall_at_{k}" for k in ks])
