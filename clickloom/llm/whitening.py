"""Embedding whitening from variances alone: polarisation gives every covariance.

An entry c becomes the integer floor(64 * c) + 1000000. With n vectors and their sums S, the centred value n * x - S is an
integer too. One pass sums the squares of these for every dimension and for the sum of every two dimensions, exactly; since
Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b), half the difference of such sums is a covariance, exactly, and rounded once. What
leaves a task are digits to the base 2**32 per sum, which Spark adds up; the driver holds one matrix of the dimensions,
decomposes it, and a last pass projects all vectors.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are dropped, and so are rows of another
length than most have (of equally frequent ones, the longest counts); entries beyond 2**55 are taken as 2**55 of their
sign; directions in which the vectors do not vary (eigenvalues that rounding alone explains) are no components; a table
without a vector, or of equal vectors only, has no rows; repeated rows are rows like any other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

COMPONENTS, SCALE, OFFSET, LARGEST = 32, 64, 1_000_000, float(1 << 61)
SLICE = 1024      # rows that are squared at once: their digits of 26 bits cannot overflow
DIGITS = 32       # bits of a digit in which sums leave the tasks


def usable(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (vec_id, v) whose vector has finite entries only."""
    rows = table.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * vectors), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length of the lists in a column: the row numbers and a matrix."""
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    length = np.diff(ends)
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        yield rows, flat[ends[rows][:, None] + np.arange(n)]


def total(values: np.ndarray) -> list[int]:
    """Exact sums of the columns of up to 2**31 rows."""
    if values.dtype == object:
        return [int(v) for v in values.sum(axis=0)]
    high, low = (values >> 32).sum(axis=0), (values & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(v) for h, v in zip(high, low)]


def squares(values: np.ndarray) -> list[int]:
    """Exact sums of the squared entries of each column, for at most ``SLICE`` rows."""
    if values.dtype == object:
        return [int(v) for v in (values * values).sum(axis=0)]
    values, found = np.abs(values), 0
    bits = int(values.max(initial=0)).bit_length()
    parts = [(values >> k) & ((1 << 26) - 1) for k in range(0, max(bits, 1), 26)]
    for p, a in enumerate(parts):
        for q, b in enumerate(parts[p:], p):
            weight = (1 if p == q else 2) << 26 * (p + q)
            found = found + np.array([weight * int(v) for v in (a * b).sum(axis=0)], object)
    return list(found)


def digits(key: Sequence[int], value: int) -> Iterator[tuple[int, ...]]:
    """Rows (key, place, digit) of a sum; the last digit has its sign."""
    place = 0
    while not -1 << DIGITS <= value < 1 << DIGITS:
        yield *key, place, value & ((1 << DIGITS) - 1)
        place, value = place + 1, value >> DIGITS
    yield *key, place, value


def records(rows: list[tuple[int, ...]], names: Sequence[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=list(names))


def assembled(rows: DataFrame, *key: str) -> dict[tuple[int, ...], int]:
    """Whole sums from digit rows; their number is bounded by the keys, not by the tasks or rows."""
    added = rows.groupBy(*key, "place").agg(F.sum("digit").alias("digit")).collect()
    out: dict[tuple[int, ...], int] = {}
    for r in added:
        at = tuple(r[k] for k in key)
        out[at] = out.get(at, 0) + (r["digit"] << DIGITS * r["place"])
    return out


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digit rows (length, dim, place, digit): sums per dimension, and the number of vectors as dim -1."""
    sums: dict[int, list[int]] = {}
    for batch in batches:
        for rows, vectors in matrices(batch.column(0)):
            found = [len(rows), *total(integers(vectors))]
            sums[len(found)] = [a + b for a, b in zip(sums.get(len(found), [0] * len(found)), found)]
    found = [row for n, values in sums.items() for dim, v in enumerate(values, -1) for row in digits((n - 1, dim), v)]
    if found:
        yield records(found, ("length", "dim", "place", "digit"))


@dataclass(frozen=True)
class Centre:
    """The number of vectors and their sums; ``of`` gives n * x - S, in 64 bits where that is enough."""

    n: int
    sums: tuple[int, ...]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        whole = [s // self.n for s in self.sums]
        near = integers(vectors).astype(object) - np.array(whole, object) if max(map(abs, whole)) > 1 << 61 else integers(vectors) - np.array(whole, np.int64)
        rest = [s - self.n * w for s, w in zip(self.sums, whole)]
        if near.dtype == object or self.n * (int(np.abs(near).max(initial=0)) + 1) >= 1 << 61:
            return near.astype(object) * self.n - np.array(rest, object)
        return near * self.n - np.array(rest, np.int64)


def centre_of(vectors: DataFrame) -> Centre | None:
    sums = vectors.select("v").mapInArrow(summed, "length bigint, dim bigint, place bigint, digit bigint")
    sums = sums.groupBy("length", "dim", "place").agg(F.sum("digit").alias("digit")).persist()
    try:
        count = F.sum(F.col("digit") * F.pow(F.lit(2.0), F.col("place") * DIGITS))
        most = sums.where("dim = -1").groupBy("length").agg(count.alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
        if most is None:
            return None
        found = assembled(sums.where(F.col("length") == most["length"]), "dim")
    finally:
        sums.unpersist()
    return Centre(found[-1,], tuple(found[d,] for d in range(most["length"])))


def squared(centre: Centre):
    dims = len(centre.sums)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digit rows (i, j, place, digit): squares of the centred dimension (i = j) and of the sum of two (i < j)."""
        sums: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, vectors in matrices(batch.column(0)):
                for at in range(0, len(vectors), SLICE):
                    centred = centre.of(vectors[at:at + SLICE])
                    for i in range(dims):
                        pairs = centred[:, i:] + centred[:, i:i + 1]
                        pairs[:, 0] = centred[:, i]
                        for j, v in enumerate(squares(pairs), i):
                            sums[i, j] = sums.get((i, j), 0) + v
        if sums:
            yield records([row for key, v in sums.items() for row in digits(key, v)], ("i", "j", "place", "digit"))

    return compute


def covariance(vectors: DataFrame, centre: Centre) -> np.ndarray:
    """The covariance matrix with divisor n, each entry the exact value rounded once."""
    found = assembled(vectors.select("v").mapInArrow(squared(centre), "i bigint, j bigint, place bigint, digit bigint"), "i", "j")
    dims, cube = len(centre.sums), centre.n ** 3
    out = np.empty((dims, dims))
    for (i, j), v in found.items():
        out[i, j] = out[j, i] = v / cube if i == j else (v - found[i, i] - found[j, j]) / (2 * cube)
    return out


@dataclass(frozen=True)
class Whitening:
    """Unit directions (columns) by falling eigenvalue, their shares of the trace, and how far from white the result is."""

    centre: Centre
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.centre.n) @ self.directions / np.sqrt(self.values)


def checked(model: Whitening):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (i, j, v): sums of products of the projections, and their sums as j -1."""
        products = 0.0
        for batch in batches:
            for _, vectors in matrices(batch.column(0)):
                white = model.project(model.centre.of(vectors))
                products = products + white.T @ np.c_[white, np.ones(len(white))]
        if np.ndim(products):
            i, j = np.indices(products.shape)
            j = np.where(j == len(products), -1, j)
            yield pa.record_batch([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(products.ravel())], names=["i", "j", "v"])

    return compute


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the vectors of the most frequent length; none if there are none or all are equal."""
    centre = centre_of(vectors)
    if centre is None:
        return None
    dims = len(centre.sums)
    vectors = vectors.where(F.size("v") == dims)
    spread = covariance(vectors, centre)
    values, directions = np.linalg.eigh(spread)
    values, directions = values[::-1], directions[:, ::-1]
    keep = int((values > dims * np.finfo(float).eps * max(values[0], 0)).sum())
    keep = min(keep, components)
    if not keep:
        return None
    values, directions = values[:keep], directions[:, :keep]
    directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), range(keep)])
    model = Whitening(centre, directions, values, values / np.trace(spread))
    sums = vectors.select("v").mapInArrow(checked(model), "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    products = np.zeros((keep, keep + 1))
    for r in sums.collect():
        products[r["i"], r["j"]] = r["v"] / centre.n
    white = products[:, :keep] - np.outer(products[:, keep], products[:, keep])
    return Whitening(centre, directions, values, model.explained, float(np.abs(white - np.eye(keep)).max()))


def projected(model: Whitening):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, vectors in matrices(batch.column(1)):
                centred = model.centre.of(vectors)
                white = model.project(centred)
                if centred.dtype != object and int(np.abs(centred).max(initial=0)).bit_length() * 2 + len(model.centre.sums).bit_length() < 63:
                    away = (centred * centred).sum(axis=1)
                else:
                    away = (centred.astype(object) ** 2).sum(axis=1)
                ends = np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel()))
                yield pa.record_batch([batch.column(0).take(pa.array(rows)), pa.array([str(v) for v in away]), lists], names=["vec_id", "deviation", "white"])

    return compute


def transform(model: Whitening, vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, component from 1, n, deviation, whitened, explained, identity_error); a deviation beyond 38 digits is null."""
    vectors = vectors.where(F.size("v") == len(model.centre.sums))
    rows = vectors.select("vec_id", "v").mapInArrow(projected(model), "vec_id bigint, deviation string, white array<double>")
    rows = rows.select("vec_id", F.col("deviation").try_cast("decimal(38,0)").alias("deviation"), F.posexplode("white").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(s)) for s in model.explained])
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.centre.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )


def whitened(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Fit on all usable rows and project them."""
    vectors = usable(table)
    model = fit(vectors, components)
    if model is None:
        empty = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return table.sparkSession.createDataFrame([], empty)
    return transform(model, vectors)
