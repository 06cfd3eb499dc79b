"""The logistic fit by Newton steps: a handful of passes over the rows instead of hundreds.

Categories that add up to one and a penalty of 1/n make the loss so flat in some directions that gradient steps need
hundreds of passes. A Newton step knows the curvature, which for some hundred features is a small matrix: tasks sum it over
their rows, Spark adds the sums, and the driver solves one system of that size. The optimum is the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

MAX_FEATURES = 1_500      # the matrix of a task takes 18 MB; beyond, gradient steps are the better choice
ROWS_AT_ONCE = 2_048
SHORTEST = 1e-6           # of a step that is halved because it brought no gain

Sums = tuple[float, np.ndarray, np.ndarray]


def sums_at(rows: DataFrame, sizes: Sequence[int], numbers: int, weights: np.ndarray) -> Sums:
    """Loss, gradient and curvature, summed over rows of (x, slots, click); the last weight is the intercept.

    A slot beyond the size of its category is a row of zeros there.
    """
    first, width = numbers + np.r_[0, np.cumsum(sizes)[:-1]].astype(int), len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss = np.zeros((width + 1, width)), 0.0
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                n, matrix = batch.num_rows, np.zeros((batch.num_rows, width))
                matrix[:, :numbers] = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, numbers)
                slots, matrix[:, -1] = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, len(sizes)), 1.0
                for k, size in enumerate(sizes):
                    known = np.flatnonzero(slots[:, k] < size)
                    matrix[known, first[k] + slots[known, k]] = 1.0
                click, at = batch.column(2).to_numpy(zero_copy_only=False), matrix @ weights
                chance = 1 / (1 + np.exp(-np.clip(at, -500, 500)))
                total[:-1] += matrix.T @ (matrix * (chance * (1 - chance))[:, None])
                total[-1] += matrix.T @ (chance - click)
                loss += float((np.logaddexp(0, at) - click * at).sum())
        lines = [*total, np.r_[loss, np.zeros(width - 1)]]
        yield pa.record_batch([pa.array(range(width + 2), pa.int32()), pa.array(lines, pa.list_(pa.float64()))], names=["line", "sums"])

    parts = rows.select("x", "slots", "click").mapInArrow(run, "line int, sums array<double>")
    added = parts.groupBy("line").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    lines = np.array([r["sums"] for r in added.orderBy("line").collect()])      # as many rows as features
    return lines[-1][0], lines[-2], lines[:-2]


def optimum(rows: DataFrame, sizes: Sequence[int], numbers: int, start: float, max_iter: int, tol: float = 1e-8) -> tuple[np.ndarray, float, int]:
    """Coefficients, intercept and number of steps of the least summed loss with half the squared coefficients as penalty.

    ``start`` is the first intercept. A step that brings no gain is halved; the last step is one that promises less than ``tol`` of the loss.
    """
    weights, steps = np.zeros(numbers + sum(sizes) + 1), 0
    weights[-1] = start
    pull = np.r_[np.ones(len(weights) - 1), 0.0]

    def at(place: np.ndarray) -> Sums:
        loss, slope, curve = sums_at(rows, sizes, numbers, place)
        return loss + 0.5 * float((pull * place ** 2).sum()), slope + pull * place, curve + np.diag(pull)

    loss, slope, curve = at(weights)
    while steps < max_iter:
        step, share = np.linalg.solve(curve, slope), 1.0
        gain, found = float(step @ slope) / 2, at(weights - step)
        while not found[0] <= loss * (1 + 1e-12) and share > SHORTEST:
            share /= 2
            found = at(weights - share * step)
        weights, (loss, slope, curve), steps = weights - share * step, found, steps + 1
        if gain <= tol * loss:
            break
    return weights[:-1], float(weights[-1]), steps
