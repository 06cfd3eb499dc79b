"""Trees on binned rows: boosting from summed histograms in ensembles that resume, and forests grown tree by tree.

Every feature becomes a bin of one byte, once, in a written table of packed blocks of rows. Categories are first replaced by
their click rate in train (a join with a written table, no list of labels on the driver), so that a split between bins is a
split of the categories by rate. A fit is a Spark job of tasks that run side by side in barrier mode, as many as the rows are worth: each
holds its share of the blocks and builds histograms (node, feature, bin -> gradient, hessian, rows) of the smaller child of every
open node; the tasks exchange and add these, take the larger child by subtraction, and all grow the same tree. Gradients are
whole multiples of 2**-20, so sums do not depend on how rows are dealt; features of few bins are counted by one code, and a row's
hessian and the row itself as one number, of which both sums can be told. A job ends after ``SEGMENT`` rounds or an early
stop and gives back its trees; the next one resumes from them, so a lost executor costs one segment. One task alone needs
no barrier; it has a process for each core that would lie idle. A fit takes all rows, with more tasks for more rows.

Trees of a forest are independent: groups of them get all blocks and grow apart, every tree on its own bootstrap weights and every
node on its own choice of features. A group keeps its blocks in a file of its task once they are more than a part, and looks into them part by part.

Boosted trees grow by best leaf. Per step, as many of the best open leaves are looked into as there are splits left, since no other can
be chosen before them; picking among known gains is then exactly what one leaf at a time would do, in as few exchanges as the
tree is deep. Missing numbers are below all others.
"""

from __future__ import annotations

import base64
import heapq
import json
import math
import mmap
import os
import tempfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.constants import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES, SEED, SMOOTHING
from clickloom.functions.scalar import smoothed
from clickloom.session import materialize

CUTS = 254                    # bin 0 is for missing numbers
BLOCK_ROWS = 8192
ROWS_PER_PROCESS = 50_000      # where a fit is worth a second process
ROWS_BESIDE = 1_000_000        # fits of up to so many rows run side by side
ROWS_PER_TASK = 5_000_000      # some 900 MB; an exchange waits a second in Spark, several times a tree, and fewer rows are counted sooner
PART_ROWS = 1 << 20           # of a forest; 40 MB of bins
CLICKS = float(1 << 26)       # a click in sums that also hold weights: no part weighs as much
SEGMENT = 500
UNIT = float(1 << 20)         # gradients and hessians are whole multiples of 1 / UNIT
ROWS_AT_ONCE, ROW = 100_000, float(1 << 35)     # a row in sums that also hold hessians, which add up to less over so many rows
CELLS = 2_048                 # of a table that counts several features at once; the innermost cache holds it
PIECE = 8_192                 # rows that are led through trees at once


@dataclass(frozen=True)
class Growth:
    """Settings of an ensemble; ``metric`` decides where early stopping finds the best round."""

    rounds: int
    step: float
    leaves: int
    depth: int
    min_rows: int = 1
    min_hessian: float = 0.0
    ridge: float = 0.0
    metric: str = "loss"


@dataclass(frozen=True)
class Forest:
    """Settings of a forest; every node tries the square root of the features."""

    trees: int = 300
    depth: int = 12
    min_rows: int = 5


# ---- categories and bins ----

def category_rates(train: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES, target: str = "click") -> DataFrame:
    """A written table (column, value, n, rate): how often each train value occurs and its smoothed click rate, in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = train.select(F.explode(pairs).alias("_p"), F.col(target).alias("_t")).select("_p.*", "_t").where("value IS NOT NULL")
    counts = counts.groupBy("column", "value").agg(F.count("_t").alias("n"), F.sum("_t").alias("_s"))
    prior = train.agg(F.avg(target)).scalar()
    return materialize(counts.select("column", "value", "n", smoothed(F.col("_s"), F.col("n"), prior, SMOOTHING).alias("rate")), "categories")


def with_category(rows: DataFrame, table: DataFrame, of: str, columns: Sequence[str], suffix: str, default: Column | float) -> DataFrame:
    """The rows with ``<column><suffix>``: what the table of categories has in ``of`` for the row's value."""
    for c in columns:
        own = table.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col(of).alias("_of"))
        joined = rows.join(own, rows[c].cast("string") == own["_value"], "left")
        rows = joined.select(*rows.columns, F.coalesce(F.col("_of"), default if isinstance(default, Column) else F.lit(default)).alias(c + suffix))
    return rows


RATE = "_rate"


def matrix_columns(numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES) -> list[str]:
    return [*numeric, *[c + RATE for c in categorical]]


def cut_points(rows: DataFrame, columns: Sequence[str], cuts: int = CUTS) -> list[list[float]]:
    """Upper bounds of the bins of each column: all values where they are few, else evenly spaced quantiles."""
    number = lambda c: F.when(~F.isnan(c), F.col(c))
    about = rows.agg(*[F.approx_count_distinct(number(c)).alias(c) for c in columns]).first()
    few = [c for c in columns if about[c] <= cuts * 3 // 4]       # certainly not more than ``cuts``
    shares = F.array(*[F.lit((k + 0.5) / cuts) for k in range(cuts)])
    found = rows.agg(*[F.collect_set(number(c)).alias(c) if c in few else F.percentile_approx(number(c), shares, 10_000).alias(c) for c in columns]).first()
    return [sorted(set(found[c] or [])) for c in columns]


def matrix_of(batch: pa.RecordBatch, first: int, count: int) -> np.ndarray:
    return np.stack([batch.column(first + k).cast(pa.float64()).to_numpy(zero_copy_only=False) for k in range(count)])


def binned(values: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """Rows of bins, one per feature; the last bin takes what is above all cuts."""
    out = np.zeros(values.shape, np.uint8)
    for k, (v, c) in enumerate(zip(values, cuts)):
        known = ~np.isnan(v)
        out[k, known] = 1 + np.searchsorted(np.asarray(c), v[known], side="left").clip(0, CUTS)
    return out


def blocks_of(rows: DataFrame, columns: Sequence[str], cuts: list[list[float]], label: str, validation: Column) -> DataFrame:
    """Written blocks (rows, bins, label, held): the bytes of up to ``BLOCK_ROWS`` rows, feature by feature."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                bins = binned(matrix_of(part, 2, len(cuts)), cuts)
                flags = [part.column(k).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes() for k in (0, 1)]
                yield pa.record_batch([pa.array([part.num_rows]), pa.array([bins.tobytes()]), *[pa.array([f]) for f in flags]], names=["rows", "bins", "label", "held"])

    chosen = rows.select(F.col(label).cast("int").alias("_y"), validation.cast("int").alias("_held"), *[F.col(c).cast("double").alias(c) for c in columns])
    return materialize(chosen.mapInArrow(pack, "rows bigint, bins binary, label binary, held binary"), "blocks")


# ---- trees ----

@dataclass(frozen=True)
class Tree:
    """Nodes as arrays: rows with ``bins[feature] <= cut`` go to ``left``, others to ``left + 1``; leaves have feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        walk, found = Walk.of(self), np.empty(bins.shape[1], np.int32)
        for at in range(0, bins.shape[1], PIECE):
            found[at:at + PIECE] = walk.leaves_of(np.ascontiguousarray(bins[:, at:at + PIECE]))
        return found

    def plain(self) -> dict:
        return {k: getattr(self, k).tolist() for k in ("feature", "cut", "left", "value", "gain")}

    @classmethod
    def of(cls, plain: dict) -> Tree:
        kinds = {"feature": np.int32, "cut": np.int32, "left": np.int32, "value": np.float64, "gain": np.float64}
        return cls(**{k: np.array(plain[k], kind) for k, kind in kinds.items()})


@dataclass(frozen=True)
class Walk:
    """A tree as tables to look up; a leaf leads to itself."""

    inner: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, tree: Tree) -> Walk:
        inner = tree.feature >= 0
        left = np.where(inner, tree.left, np.arange(len(inner))).astype(np.intp)
        return cls(inner, np.where(inner, tree.feature, 0).astype(np.intp), np.where(inner, tree.cut, 255).astype(np.uint8), left, tree.value)

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row; of bins that the processor's cache holds, or it takes much longer."""
        flat, width = bins.ravel(), bins.shape[1]
        found, rows, node = np.zeros(width, np.intp), np.arange(width), np.zeros(width, np.intp)
        while len(rows):
            live = self.inner.take(node)
            if 2 * np.count_nonzero(live) <= len(rows):
                found[rows] = node
                rows, node = rows[live], node[live]
            node = self.left.take(node) + (flat.take(self.feature.take(node) * width + rows) > self.cut.take(node))
        return found


Sum = Callable[[np.ndarray], np.ndarray]


@dataclass
class Leaf:
    rows: np.ndarray                      # of this task
    total: np.ndarray                     # gradient, hessian, rows of all tasks
    depth: int
    histogram: np.ndarray | None = None   # (3, features, bins) of all tasks, added up to each bin
    split: tuple[float, int, int] | None = None
    children: tuple[Leaf, Leaf] | None = None


def score_of(total: np.ndarray, ridge: float) -> np.ndarray:
    return total[0] ** 2 / np.maximum(total[1] + ridge, 1e-12)


def best_split(leaf: Leaf, grow: Growth) -> tuple[float, int, int] | None:
    """(gain, feature, cut) of the best split of a leaf; of equal gains the first feature and cut."""
    if leaf.depth >= grow.depth or leaf.total[2] < 2 * grow.min_rows:
        return None
    below = leaf.histogram[:, :, :-1]
    above = leaf.total[:, None, None] - below
    allowed = (below[2] >= max(1, grow.min_rows)) & (above[2] >= max(1, grow.min_rows))
    allowed &= (below[1] >= grow.min_hessian) & (above[1] >= grow.min_hessian)
    gain = np.where(allowed, score_of(below, grow.ridge) + score_of(above, grow.ridge) - score_of(leaf.total, grow.ridge), -np.inf)
    at = int(gain.argmax())
    feature, cut = divmod(at, gain.shape[1])
    return (float(gain.flat[at]), feature, cut) if gain.flat[at] > 1e-10 else None


@dataclass(frozen=True)
class Joined:
    """Features that are counted together: the code of a row is the place of its bins in their grid."""

    features: tuple[int, ...]
    sizes: tuple[int, ...]
    codes: np.ndarray
    to_bins: tuple[np.ndarray, np.ndarray, np.ndarray]     # the sums of codes that make those of bins, their features and bins

    @classmethod
    def of(cls, bins: np.ndarray, features: Sequence[int], sizes: Sequence[int]) -> Joined:
        codes = bins[features[0]]
        for f, size in zip(features[1:], sizes[1:]):
            codes = codes * np.uint16(size) + bins[f]
        grid = np.indices(sizes).reshape(len(sizes), -1) if len(sizes) > 1 else np.zeros((0, 0), int)
        parts = [(g[:, None] == np.arange(size)).astype(float) for g, size in zip(grid, sizes)]
        whole = np.concatenate(parts, axis=1) if parts else np.zeros((0, 0))
        return cls(tuple(features), tuple(sizes), codes, (whole, np.repeat(features, sizes), np.concatenate([np.arange(size) for size in sizes])))

    @property
    def cells(self) -> int:
        return math.prod(self.sizes)

    def put(self, sums: np.ndarray, of_codes: np.ndarray) -> None:
        """Write the sums of bins into (leaves, features, 256)."""
        whole, feature, at = self.to_bins
        sums[:, feature, at] = of_codes @ whole if len(self.features) > 1 else of_codes


def joined(bins: np.ndarray) -> list[Joined]:
    """All features, those of few bins together as long as their table stays small."""
    sizes = [int(b.max(initial=0)) + 1 for b in bins]
    groups: list[list[int]] = []
    for f in sorted(range(len(bins)), key=lambda f: sizes[f]):
        if groups and math.prod(sizes[g] for g in groups[-1]) * sizes[f] <= CELLS:
            groups[-1].append(f)
        else:
            groups.append([f])
    return [Joined.of(bins, g, [sizes[f] for f in g]) for g in groups]


def histograms(features: int, groups: Sequence[Joined], leaves: Sequence[Leaf], gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(leaves, 3, features, bins) over this task's rows of the leaves; a row weighs its hessian and ``ROW``."""
    rows = np.concatenate([leaf.rows for leaf in leaves])
    slot = np.repeat(np.arange(len(leaves)), [len(leaf.rows) for leaf in leaves])
    out = np.zeros((3, len(leaves), features, 256))
    for start in range(0, len(rows), ROWS_AT_ONCE):
        part, at = rows[start:start + ROWS_AT_ONCE], slot[start:start + ROWS_AT_ONCE]
        sums = np.zeros((2, len(leaves), features, 256))
        weights = gradient.take(part), weight.take(part)
        for group in groups:
            place = group.codes.take(part) + at * group.cells
            for k in range(2):
                group.put(sums[k], np.bincount(place, weights[k], minlength=len(leaves) * group.cells).reshape(len(leaves), -1))
        count = np.floor(sums[1] / ROW)
        out[0] += sums[0]
        out[1] += sums[1] - count * ROW
        out[2] += count
    return out.swapaxes(0, 1)


def shared(shape: tuple[int, ...], kind: type = np.float64) -> np.ndarray:
    """An array that a process and its children read and write."""
    return np.frombuffer(mmap.mmap(-1, max(1, math.prod(shape) * np.dtype(kind).itemsize)), kind, math.prod(shape)).reshape(shape)


class Team:
    """The processes of one task that count: each has some of the features, and all read the same rows and weights.

    Children wait for the number of leaves on a pipe, and end when it is closed.
    """

    def __init__(self, bins: np.ndarray, processes: int, leaves: int):
        self.gradient, self.weight = shared((bins.shape[1],)), shared((bins.shape[1],))
        self.rows, self.lengths = shared((bins.shape[1],), np.int64), shared((leaves,), np.int64)
        self.out = shared((leaves, 3, len(bins), 256))
        order = np.argsort(bins.max(axis=1, initial=0), kind="stable")
        shares = [np.sort(order[k::processes]) for k in range(processes)]
        self.children = [self.child(bins, own) for own in shares[1:]]
        self.own, self.groups = shares[0], joined(bins[shares[0]] if processes > 1 else bins)

    def child(self, bins: np.ndarray, own: np.ndarray) -> tuple[int, int, int]:
        (ask, asked), (done, finished) = os.pipe(), os.pipe()
        pid = os.fork()
        if pid:
            os.close(ask), os.close(finished)
            return pid, asked, done
        try:
            os.close(asked), os.close(done)
            self.own, self.groups = own, joined(bins[own])
            while head := os.read(ask, 4):
                self.count(int.from_bytes(head, "little"))
                os.write(finished, b".")
        finally:
            os._exit(0)

    def count(self, leaves: int) -> None:
        ends = np.cumsum(self.lengths[:leaves])
        parts = [Leaf(self.rows[end - length:end], np.zeros(3), 0) for end, length in zip(ends, self.lengths)]
        self.out[:leaves, :, self.own] = histograms(len(self.own), self.groups, parts, self.gradient, self.weight)

    def __call__(self, leaves: Sequence[Leaf]) -> np.ndarray:
        if not self.children:
            return histograms(len(self.own), self.groups, leaves, self.gradient, self.weight)
        self.lengths[:len(leaves)] = [len(leaf.rows) for leaf in leaves]
        np.concatenate([leaf.rows for leaf in leaves], out=self.rows[:sum(len(leaf.rows) for leaf in leaves)])
        for _, asked, _ in self.children:
            os.write(asked, len(leaves).to_bytes(4, "little"))
        self.count(len(leaves))
        if any(os.read(done, 1) != b"." for *_, done in self.children):
            raise RuntimeError("a process that counts has ended")
        return self.out[:len(leaves)]

    def close(self) -> None:
        for _, asked, done in self.children:       # all first: a child also holds the pipes of those before it
            os.close(asked), os.close(done)
        for pid, *_ in self.children:
            os.waitpid(pid, 0)
        self.children = []


Count = Callable[[Sequence[Leaf]], np.ndarray]


def look_into(leaves: Sequence[Leaf], bins: np.ndarray, count: Count, grow: Growth, add: Sum) -> None:
    """Split the leaves, sum the histograms of the smaller children over all tasks and get the others by subtraction."""
    small = []
    for leaf in leaves:
        _, feature, cut = leaf.split
        left = bins[feature].take(leaf.rows) <= cut
        total = leaf.histogram[:, feature, cut].copy()
        leaf.children = Leaf(leaf.rows[left], total, leaf.depth + 1), Leaf(leaf.rows[~left], leaf.total - total, leaf.depth + 1)
        leaf.rows = leaf.rows[:0].copy()
        small.append(min(leaf.children, key=lambda c: c.total[2]))
    deepest = leaves[0].depth + 1 >= grow.depth if len({leaf.depth for leaf in leaves}) == 1 else False
    if deepest:
        return
    found = add(count(small)).cumsum(axis=3)
    for leaf, child, histogram in zip(leaves, small, found):
        other = leaf.children[1] if child is leaf.children[0] else leaf.children[0]
        child.histogram, other.histogram = histogram, leaf.histogram - histogram
        for c in leaf.children:
            c.split = best_split(c, grow)
        leaf.histogram = None


def grow_tree(bins: np.ndarray, used: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, grow: Growth, add: Sum) -> Tree:
    groups, weight = joined(bins), hessian + ROW
    return grown_tree(bins, lambda leaves: histograms(len(bins), groups, leaves, gradient, weight), used, grow, add)[0]


def grown_tree(bins: np.ndarray, count: Count, used: np.ndarray, grow: Growth, add: Sum) -> tuple[Tree, list[tuple[float, np.ndarray]]]:
    """The tree, and the value and rows of each of its leaves."""
    root = Leaf(used, np.zeros(3), 0)
    root.histogram = add(count([root]))[0].cumsum(axis=2)
    root.total = root.histogram[:, 0, -1].copy()
    root.split = best_split(root, grow)
    order, nodes = [], [root]
    heap = [(-root.split[0], 0)] if root.split else []
    feature, cut, left, gain = [-1], [0], [0], [0.0]
    while heap and len(order) < grow.leaves - 1:
        at = heap[0][1]
        leaf = nodes[at]
        if leaf.children is None:
            open_leaves = [nodes[k] for _, k in heapq.nsmallest(grow.leaves - 1 - len(order), heap) if nodes[k].children is None]
            look_into(open_leaves, bins, count, grow, add)
        heapq.heappop(heap)
        order.append(at)
        gain[at], feature[at], cut[at] = leaf.split
        left[at] = len(nodes)
        for child in leaf.children:
            if child.split:
                heapq.heappush(heap, (-child.split[0], len(nodes)))
            nodes.append(child)
            for column, empty in ((feature, -1), (cut, 0), (left, 0), (gain, 0.0)):
                column.append(empty)
    value = [0.0 if f >= 0 else -grow.step * n.total[0] / max(n.total[1] + grow.ridge, 1e-12) for n, f in zip(nodes, feature)]
    rows = [(v, r) for n, f, v in zip(nodes, feature, value) if f < 0 for r in ([n.rows] if n.children is None else [c.rows for c in n.children])]
    return Tree(np.array(feature, np.int32), np.array(cut, np.int32), np.array(left, np.int32), np.array(value), np.array(gain) / UNIT), rows


# ---- fitting ----

def probability_of(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-raw))


def judged(raw: np.ndarray, label: np.ndarray, metric: str, add: Sum) -> float:
    """Mean loss, or one minus the area under the curve (probabilities in 2**14 steps), over all tasks' held rows."""
    p = probability_of(raw)
    if metric == "loss":
        q = np.clip(np.where(label == 1, p, 1 - p), 1e-15, None)
        total = add(np.array([np.rint(-np.log(q) * UNIT).sum(), len(q)]))
        return total[0] / UNIT / max(total[1], 1)
    step = np.minimum((p * (1 << 14)).astype(np.int64), (1 << 14) - 1)
    pos, neg = add(np.stack([np.bincount(step[label == k], minlength=1 << 14) for k in (1, 0)]).astype(float))
    below = neg.cumsum() - neg
    return 1 - (pos * (below + neg / 2)).sum() / max(pos.sum() * neg.sum(), 1)


def message(numbers: np.ndarray) -> str:
    """Whole numbers as text: which are not zero, then these, byte plane by byte plane (the upper planes are nearly empty)."""
    flat = numbers.ravel()
    there = flat != 0
    some = flat[there]
    kind = "<i4" if np.abs(some).max(initial=0) < 1 << 31 else "<i8"
    planes = some.astype(kind).view(np.uint8).reshape(len(some), int(kind[2])).T
    raw = kind[2].encode() + np.packbits(there).tobytes() + planes.tobytes()
    return f"{len(raw)}:" + base64.b64encode(pa.compress(raw, codec="zstd", asbytes=True)).decode()


def numbers_of(text: str, shape: tuple[int, ...]) -> np.ndarray:
    size, packed = text.split(":")
    raw = np.frombuffer(pa.decompress(base64.b64decode(packed), int(size), codec="zstd", asbytes=True), np.uint8)
    out, width = np.zeros(int(np.prod(shape))), int(chr(raw[0]))
    end = 1 + -(-len(out) // 8)
    there = np.unpackbits(raw[1:end], count=len(out)).view(bool)
    out[there] = np.ascontiguousarray(raw[end:].reshape(width, -1).T).view(f"<i{width}").ravel()
    return out.reshape(shape)


def summing(context: BarrierTaskContext | None) -> Sum:
    """Adds an array of whole numbers over all tasks, in the order of their numbers."""
    def add(mine: np.ndarray) -> np.ndarray:
        total = np.zeros(mine.shape)
        for part in context.allGather(message(mine)):
            total += numbers_of(part, mine.shape)
        return total

    return add if context else lambda mine: mine


def boosting_task(trees: list[dict], base: float, history: list[float], grow: Growth, segment: int, patience: int | None, features: int, barrier: bool, processes: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get() if barrier else None
        add = summing(context)
        parts = [r for b in batches for r in b.to_pylist()]
        bins = np.concatenate([np.zeros((features, 0), np.uint8), *[np.frombuffer(r["bins"], np.uint8).reshape(features, -1) for r in parts]], axis=1)
        flat = lambda name: np.frombuffer(b"".join(r[name] for r in parts), np.uint8)
        label, held = flat("label").astype(np.int8), flat("held") == 1
        parts.clear()
        kept = bins[:, held], label[held]
        if held.any():
            bins, label = bins[:, ~held], label[~held]
        team, used = Team(bins, processes, grow.leaves), np.arange(bins.shape[1])
        raw, judge = np.full(len(label), base), np.full(len(kept[1]), base)
        for plain in trees:
            tree = Tree.of(plain)
            raw += tree.value[tree.leaves_of(bins)]
            judge += tree.value[tree.leaves_of(kept[0])]
        found, told = [], list(history)
        scaled = replace(grow, ridge=grow.ridge * UNIT, min_hessian=grow.min_hessian * UNIT)
        while len(found) < segment and len(trees) + len(found) < grow.rounds:
            p = probability_of(raw)
            team.gradient[:], team.weight[:] = np.rint((p - label) * UNIT), np.rint(p * (1 - p) * UNIT) + ROW
            del p
            tree, leaves = grown_tree(bins, team, used, scaled, add)
            for value, rows in leaves:
                raw[rows] += value
            found.append(tree)
            if patience is not None:
                judge += tree.value[tree.leaves_of(kept[0])]
                told.append(judged(judge, kept[1], grow.metric, add))
                if len(told) - 1 - int(np.argmin(told)) >= patience:
                    break
        team.close()
        if context is None or context.partitionId() == 0:
            rows = [json.dumps(t.plain()) for t in found]
            yield pa.record_batch([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string()), pa.array(told[len(history):] or [None] * len(rows), pa.float64())], names=["round", "tree", "metric"])

    return run


def gathered(rows: DataFrame, key: str) -> list:
    """All rows in the order of ``key``, sorted here: to sort them in Spark would run the fit before twice, once to find the ranges."""
    return sorted(rows.collect(), key=lambda r: r[key])


def processes_of_a_task(spark: SparkSession, beside: int) -> int:
    """How many cores of an executor a lone task may use while ``beside`` such tasks run and no others."""
    slots, conf = spark.sparkContext.defaultParallelism, spark.sparkContext.getConf()
    own = slots if spark.sparkContext.master.startswith("local[") else int(conf.get("spark.executor.cores", "1"))
    return max(1, min(own, slots // max(1, beside)))


def fitted_trees(blocks: DataFrame, features: int, base: float, grow: Growth, patience: int | None = None, tasks: int | None = None, segment: int = SEGMENT, beside: int = 1) -> tuple[list[dict], list[float]]:
    """The trees and, with ``patience``, the metric of every round; jobs of ``segment`` rounds that resume from one another.

    The processes of ``beside`` such fits at a time are no more than the tasks the cluster runs at a time.
    """
    rows = blocks.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if tasks is None:
        tasks = max(1, min(-(-rows // ROWS_PER_TASK), blocks.sparkSession.sparkContext.defaultParallelism))
    processes = processes_of_a_task(blocks.sparkSession, beside) if tasks == 1 and rows >= ROWS_PER_PROCESS else 1
    dealt = blocks.coalesce(1) if tasks == 1 else blocks.repartition(tasks)
    trees: list[dict] = []
    history: list[float] = []
    while len(trees) < grow.rounds:
        run = boosting_task(trees, base, history, grow, segment, patience, features, tasks > 1, processes)
        found = gathered(dealt.mapInArrow(run, "round bigint, tree string, metric double", barrier=tasks > 1), "round")
        trees += [json.loads(r["tree"]) for r in found]
        history += [r["metric"] for r in found if r["metric"] is not None]
        if len(found) < segment or patience is not None and len(history) - 1 - int(np.argmin(history)) >= patience:
            break
    return trees, history


# ---- forests ----

def level_sums(parts: Sequence[np.ndarray], opened: Callable[[int], tuple[np.ndarray, np.ndarray]], weight: np.ndarray, label: np.ndarray, features: np.ndarray) -> np.ndarray:
    """(2, nodes, choices, 256): weights and clicks of the rows in nodes of a level, by bins of the features the nodes try.

    ``opened`` gives the rows of a part that are in such nodes, and their nodes. Both sums of a part share one double.
    """
    nodes, choices = features.shape
    sums, start = np.zeros((2, nodes, choices, 256)), 0
    for at, part in enumerate(parts):
        rows, slot = opened(at)
        both = weight[start + rows] * (1.0 + label[start + rows] * CLICKS)
        first = slot << 8
        for k in range(choices):
            found = np.bincount(first + part[features[slot, k], rows], both, minlength=nodes << 8).reshape(nodes, 256)
            clicks = np.floor(found / CLICKS)
            sums[0, :, k] += found - clicks * CLICKS
            sums[1, :, k] += clicks
        start += part.shape[1]
    return sums


def level_splits(sums: np.ndarray, features: np.ndarray, min_rows: int) -> tuple[np.ndarray, ...]:
    """Per node of a level the best of its features (nodes, choices): gain, feature and cut."""
    every = np.arange(len(features))
    best, chosen, cuts = np.zeros(len(features)), features[:, 0].copy(), np.zeros(len(features), np.int64)
    for k in range(features.shape[1]):
        below = sums[:, :, k].cumsum(axis=2)
        total, below = below[..., -1:], below[..., :-1]
        above = total - below
        allowed = (below[0] >= min_rows) & (above[0] >= min_rows)
        part = lambda s: s[1] ** 2 / np.maximum(s[0], 1e-12)
        gain = np.where(allowed, part(below) + part(above) - part(total), 0.0)
        at = gain.argmax(axis=1)
        better = gain[every, at] > best
        best[better], chosen[better], cuts[better] = gain[every, at][better], features[better, k], at[better]
    return best, chosen, cuts


def forest_tree(bins: np.ndarray | Sequence[np.ndarray], label: np.ndarray, forest: Forest, number: int) -> Tree:
    """One tree of a forest, level by level; its number alone decides all that is random.

    The bins may come in parts of consecutive rows, which are looked into one after the other.
    """
    parts = [bins] if isinstance(bins, np.ndarray) else bins
    rng = np.random.default_rng((SEED, number))
    weight = np.concatenate([np.zeros(0, np.uint8), *[rng.poisson(1.0, p.shape[1]).astype(np.uint8) for p in parts]])
    place = np.where(weight > 0, 0, -1).astype(np.int32)      # the node of each row; rows without weight are in none
    features, tried = len(parts[0]), max(1, int(math.sqrt(len(parts[0]))))
    ends = np.cumsum([p.shape[1] for p in parts])
    spans = [slice(int(end) - p.shape[1], int(end)) for end, p in zip(ends, parts)]
    levels: list[dict[str, np.ndarray]] = []
    sums_of = lambda first, count: sum(_weights(place[s], first, count, weight[s], label[s]) for s in spans)
    first, nodes = 0, 1
    for depth in range(forest.depth + 1):
        level = {"feature": np.full(nodes, -1, np.int32), "cut": np.zeros(nodes, np.int32), "left": np.zeros(nodes, np.int32), "gain": np.zeros(nodes)}
        levels.append(level)
        if depth == forest.depth or not nodes:
            break
        picked = rng.random((nodes, features)).argsort(axis=1)[:, :tried]
        total, clicks = sums_of(first, nodes)
        worth = (total >= 2 * forest.min_rows) & (clicks > 0) & (clicks < total)
        gain, feature, cut = np.zeros(nodes), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)

        def opened(at: int, of: np.ndarray = worth) -> tuple[np.ndarray, np.ndarray]:
            slot = place[spans[at]].astype(np.int64) - first
            rows = np.flatnonzero(slot >= 0)
            rows = rows[of[slot[rows]]]
            return rows, (np.cumsum(of) - 1)[slot[rows]]

        if worth.any():
            gain[worth], feature[worth], cut[worth] = level_splits(level_sums(parts, opened, weight, label, picked[worth]), picked[worth], forest.min_rows)
        split = gain > 1e-10
        left = first + nodes + 2 * (np.cumsum(split) - split)
        for name, value in (("feature", feature), ("cut", cut), ("left", left), ("gain", gain)):
            level[name][split] = value[split]
        for at, part in enumerate(parts):
            rows, slot = opened(at, split)
            node = np.flatnonzero(split)[slot]
            place[spans[at]][rows] = left[node] + (part[feature[node], rows] > cut[node])
        first, nodes = first + nodes, 2 * int(split.sum())
    whole = {k: np.concatenate([level[k] for level in levels]) for k in levels[0]}
    total, clicks = sums_of(0, len(whole["feature"]))
    return Tree(whole["feature"], whole["cut"], whole["left"], clicks / np.maximum(total, 1e-12), whole["gain"])


def _weights(place: np.ndarray, first: int, nodes: int, weight: np.ndarray, label: np.ndarray) -> np.ndarray:
    """(2, nodes): weights and clicks of the rows in each of the nodes from ``first`` on."""
    rows = np.flatnonzero(place >= first)
    at, w = place[rows] - first, weight[rows].astype(np.float64)
    return np.stack([np.bincount(at, w, minlength=nodes), np.bincount(at, w * label[rows], minlength=nodes)])


class Parts(Sequence):
    """Blocks of one group of trees as parts of up to ``PART_ROWS`` rows. More than one part is kept in a temporary file, of which
    only the part that is looked into is mapped."""

    def __init__(self, features: int):
        self.features, self.file = features, None
        self.open: list[np.ndarray] = []
        self.places: list[tuple[int, tuple[int, int]]] = []
        self.labels: list[bytes] = []

    def add(self, bins: bytes, label: bytes) -> None:
        if self.open and sum(b.shape[1] for b in self.open) + len(label) > PART_ROWS:
            self.write()
        self.open.append(np.frombuffer(bins, np.uint8).reshape(self.features, -1))
        self.labels.append(label)

    def write(self) -> None:
        part, self.open = np.concatenate(self.open, axis=1), []
        self.file = self.file or tempfile.TemporaryFile()
        self.places.append((self.file.seek(0, 2), part.shape))
        self.file.write(part.data)
        self.file.flush()

    def closed(self) -> np.ndarray | Parts:
        """All rows: an array, or the parts of the file."""
        if not self.places:
            return np.concatenate([np.zeros((self.features, 0), np.uint8), *self.open], axis=1)
        if self.open:
            self.write()
        return self

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, k: int) -> np.ndarray:
        at, shape = self.places[k]
        return np.memmap(self.file, np.uint8, "r", at, shape)

    def label(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.labels), np.uint8)


def dealt_to_groups(blocks: DataFrame, groups: int) -> DataFrame:
    """A copy of the blocks for every group of trees, each in a partition of its own, ordered by their numbers."""
    numbered = materialize(blocks.select(F.monotonically_increasing_id().alias("block"), "bins", "label"), "numbered-blocks")
    copies = numbered.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "*")
    return copies.repartitionById(groups, F.col("group")).sortWithinPartitions("group", "block")


def forest_trees(blocks: DataFrame, features: int, forest: Forest, groups: int | None = None) -> list[dict]:
    """All trees; the blocks go to every group of trees once, ordered by their numbers."""
    groups = groups or max(1, min(forest.trees, blocks.sparkSession.sparkContext.defaultParallelism))

    def grow_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Parts] = {}
        for batch in batches:
            for group, bins, label in zip(*[batch.column(batch.schema.get_field_index(c)) for c in ("group", "bins", "label")]):
                found.setdefault(group.as_py(), Parts(features)).add(bins.as_py(), label.as_py())
        for group, own in found.items():
            parts, label = own.closed(), own.label()
            for number in range(group, forest.trees, groups):
                tree = json.dumps(forest_tree(parts, label, forest, number).plain())
                yield pa.record_batch([pa.array([number]), pa.array([tree])], names=["number", "tree"])

    grown = dealt_to_groups(blocks, groups).mapInArrow(grow_group, "number bigint, tree string")
    return [json.loads(r["tree"]) for r in gathered(grown, "number")]


@dataclass(frozen=True)
class TreeModel:
    """A fitted ensemble; ``categories`` is a written table of rates, all else is small. A forest has no base: it averages."""

    settings: Growth | Forest
    base: float | None
    cuts: list[list[float]]
    trees: list[dict]
    categories: DataFrame = field(repr=False)
    prior: float = 0.0
    columns: tuple[str, ...] = tuple(matrix_columns())

    def matrix(self, rows: DataFrame) -> DataFrame:
        missing = [c.removesuffix(RATE) for c in self.columns if c.endswith(RATE) and c not in rows.columns]
        return with_category(rows, self.categories, "rate", missing, RATE, self.prior)

    def scorer(self) -> Callable[[np.ndarray], np.ndarray]:
        """Probabilities of a matrix (features, rows) of numbers."""
        cuts, base = self.cuts, self.base
        trees = [replace(Tree.of(plain), gain=np.zeros(0)) for plain in self.trees]      # arrays travel faster than lists
        walks: list[Walk] = []

        def score(values: np.ndarray) -> np.ndarray:
            if not walks:
                walks.extend(map(Walk.of, trees))
            raw = np.full(values.shape[1], base or 0.0)
            for at in range(0, len(raw), PIECE):
                bins, part = binned(values[:, at:at + PIECE], cuts), raw[at:at + PIECE]
                for walk in walks:
                    part += walk.value.take(walk.leaves_of(bins))
            return raw / max(len(trees), 1) if base is None else probability_of(raw)

        return score

    def scored(self, rows: DataFrame, *keep: str) -> DataFrame:
        """The kept columns and ``score`` of every row, in one pass of Arrow batches."""
        score, columns = self.scorer(), list(self.columns)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = score(matrix_of(batch, len(keep), len(columns)))
                yield pa.record_batch([*[batch.column(k) for k in range(len(keep))], pa.array(found)], names=[*keep, "score"])

        chosen = self.matrix(rows).select(*keep, *[F.col(c).cast("double").alias(f"_x{k}") for k, c in enumerate(columns)])
        schema = chosen.select(*keep).schema.add("score", "double")
        return chosen.mapInArrow(run, schema)

    def importance(self) -> list[tuple[str, float]]:
        """Each feature's share of all gains."""
        total = np.zeros(len(self.columns))
        for plain in self.trees:
            tree = Tree.of(plain)
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return list(zip([c.removesuffix(RATE) for c in self.columns], (total / max(total.sum(), 1e-300)).tolist()))

    def save(self, path: str) -> None:
        spark = self.categories.sparkSession
        record = json.dumps({"kind": type(self.settings).__name__, "settings": vars(self.settings), "base": self.base, "cuts": self.cuts, "trees": self.trees, "prior": self.prior, "columns": self.columns})
        spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/trees")
        self.categories.write.mode("overwrite").parquet(f"{path}/categories")

    @classmethod
    def load(cls, path: str) -> TreeModel:
        spark = SparkSession.active()
        r = json.loads(spark.read.text(f"{path}/trees").first()[0])
        kind = {k.__name__: k for k in (Growth, Forest)}[r["kind"]]
        return cls(kind(**r["settings"]), r["base"], r["cuts"], r["trees"], spark.read.parquet(f"{path}/categories"), r["prior"], tuple(r["columns"]))


@dataclass(frozen=True)
class Prepared:
    """What is learned from the rows that are fitted on (categories, click rate, cuts), and all rows as blocks."""

    categories: DataFrame
    clicks: float
    cuts: list[list[float]]
    blocks: DataFrame

    @classmethod
    def of(cls, rows: DataFrame, held: Column | None = None, numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES) -> Prepared:
        held = F.lit(False) if held is None else held
        known, columns = rows.where(~held), matrix_columns(numeric, categorical)
        clicks = known.agg(F.avg("click")).first()[0] or 0.0
        categories = category_rates(known, categorical)
        full = with_category(rows, categories, "rate", categorical, RATE, clicks)
        full = materialize(full.select("click", held.alias("_held"), *[F.col(c).cast("double").alias(c) for c in columns]), "matrix")
        cuts = cut_points(full.where(~F.col("_held")), columns)
        return cls(categories, clicks, cuts, blocks_of(full, columns, cuts, "click", F.col("_held")))


def log_odds(p: float) -> float:
    return math.log(max(p, 1e-12) / max(1 - p, 1e-12))


def search(known: Prepared, grow: Growth, patience: int, tasks: int | None = None, beside: int = 1) -> tuple[list[dict], list[float]]:
    """Trees, and how the held rows judge each round, until ``patience`` more rounds bring nothing."""
    return fitted_trees(known.blocks, len(known.cuts), log_odds(known.clicks), grow, patience, tasks, beside=beside)


def fit(known: Prepared, grow: Growth, tasks: int | None = None, beside: int = 1) -> TreeModel:
    """All rounds of the setting."""
    trees, _ = fitted_trees(known.blocks, len(known.cuts), log_odds(known.clicks), grow, None, tasks, beside=beside)
    return TreeModel(grow, log_odds(known.clicks), known.cuts, trees, known.categories, known.clicks)


def fit_forest(known: Prepared, forest: Forest, groups: int | None = None) -> TreeModel:
    trees = forest_trees(known.blocks, len(known.cuts), forest, groups)
    return TreeModel(forest, None, known.cuts, trees, known.categories, known.clicks)
