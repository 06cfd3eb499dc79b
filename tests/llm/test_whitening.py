import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import whitening
from clickloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def slow(rows, dims):
    """Sums, exact covariances and exact deviations of (id, vector) rows."""
    x = [[math.floor(64 * Fraction(float(c))) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    d = [[n * c - s for c, s in zip(r, sums)] for r in x]
    cov = [[float(Fraction(sum(r[i] * r[j] for r in d), n ** 3)) for j in range(dims)] for i in range(dims)]
    return n, sums, np.array(cov), [sum(c * c for c in r) for r in d], np.array(d, object)


def check(got, rows, dims, components=32):
    n, _, cov, deviations, centred = slow(rows, dims)
    values = np.linalg.eigvalsh(cov)[::-1]
    keep = min(components, int((values > dims * 2.3e-16 * values[0]).sum()))
    assert len(got) == keep * len(rows)
    by_id = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-4
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-4 * r.explained
        by_id.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, []).append(r.whitened)
    assert sorted({k for k in by_id}, key=str) == sorted({(i, v) for (i, _), v in zip(rows, deviations)}, key=str)
    white = np.array([[by_id[i, v][c][0] for c in range(1, keep + 1)] for (i, _), v in zip(rows, deviations)])
    assert np.abs(white.T @ white / n - np.eye(keep)).max() < 1e-6
    if keep == dims:        # all of it: distances are those that the inverse covariance gives
        centred = centred.astype(float) / n
        want = np.einsum("ij,jk,ik->i", centred, np.linalg.inv(cov), centred)
        assert np.allclose((white ** 2).sum(axis=1), want, rtol=1e-6)


def collected(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    return whitening.whitened(df).collect()


def test_whole_table_equals_exact_arithmetic(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = QUERIES["op11_whitening"](spark, FOLDER)
    assert dict(got.dtypes)["deviation"] == "bigint" and dict(got.dtypes)["component"] == "int"
    check(got.collect(), rows, len(rows[0][1]))


def test_covariances_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=6) * [1, 100, 1e4, 1e-3, 1e6, 3] + 50]) for i in range(90)]
    vectors = whitening.usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4))
    centre = whitening.centre_of(vectors)
    n, sums, cov, *_ = slow(rows, 6)
    assert (centre.n, list(centre.sums)) == (n, sums)
    assert (whitening.covariance(vectors, centre) == cov).all()


def test_unusable_rows_are_dropped(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(np.float32(v)) for v in rng.normal(size=4)]) for i in range(20)] + [(3, [9.0, 1.0, 2.0, -5.0])] * 2
    odd = [(50, None), (51, [1.0, None, 2.0, 3.0]), (52, [NAN, 0.0, 0.0, 0.0]), (53, [0.0, -INF, 0.0, 0.0]), (54, []), (55, [1.0, 2.0])]
    check(collected(spark, good + odd), good, 4)


def test_null_ids_and_clashing_columns(spark):
    rows = [(None, [1.0, 2.0]), (1, [2.0, 0.0]), (2, [5.0, 1.0]), (None, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    for name in ("v", "white", "component", "n", "deviation", "at", "length", "dim"):
        df = df.withColumn(name, F.lit("x"))
    check(whitening.whitened(df).collect(), rows, 2)


def test_no_variation_and_no_rows(spark):
    assert collected(spark, []) == [] and collected(spark, [(1, None)]) == []
    assert collected(spark, [(1, [1.0, 2.0])] * 5) == []
    got = collected(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)])        # one direction only
    assert {r.component for r in got} == {1} and len(got) == 9 and abs(got[0].explained - 1) < 1e-9


@pytest.mark.parametrize("size", [1e3, 1e12, 1e20])
def test_large_entries_stay_exact(spark, size):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=3) * size]) for i in range(30)]
    limit = whitening.LARGEST / 64
    clipped = [(i, [max(-limit, min(limit, c)) for c in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    centre = whitening.centre_of(whitening.usable(df))
    n, sums, cov, *_ = slow(clipped, 3)
    assert list(centre.sums) == sums
    assert (whitening.covariance(whitening.usable(df), centre) == cov).all()
    assert {r.component for r in whitening.whitened(df).collect()} == {1, 2, 3}
