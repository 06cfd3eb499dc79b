"""Exact links between sets of shingles, without a row per pair.

Candidates come as a graph: rows (a, b) that connect, directly or over others, whatever may be similar. A cluster is a
component of it. What is known to be linked has a common root; only members of different roots are compared, on their full
sets, inside tasks that give back a spanning forest. A cluster is cut by weight into parts: its largest root (a group of
copies, say) meets the others once per part of the *others*, never itself. A cluster of k texts that all are close but not
similar costs a comparison per pair, in blocks that run apart; no pair becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.base import lists, raw_texts, shingles, star_forest
from clickloom.session import materialize

PART_ROWS, PART_SHINGLES = 512, 1 << 20    # of a part; two parts are one unit of work
CHUNK = 2048                               # shingles in a row, so that batches of long texts stay small


def shingle_chunks(text: Column, width: int) -> Column:
    """A text's distinct shingle hashes in ascending order, in runs of at most ``CHUNK``."""
    @F.arrow_udf("array<array<bigint>>")
    def compute(texts: pa.Array) -> pa.Array:
        runs, ends = [], [0]
        for raw in raw_texts(texts):
            members = np.unique(shingles(raw, width))
            runs += [members[k:k + CHUNK] for k in range(0, max(1, len(members)), CHUNK)]
            ends.append(len(runs))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lists(runs))

    return compute(text)


def chunked_size(chunks: str) -> Column:
    return F.aggregate(chunks, F.lit(0), lambda n, c: n + F.size(c)).cast("bigint")


def inverted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all sets, numbered: owners by shingle with their starts, and shingle numbers by owner with theirs."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(number, kind="stable")
    starts = np.r_[0, np.cumsum(np.bincount(number))]
    return owner[order], starts, number, np.r_[0, np.cumsum(sizes)]


def similar_links(sets: list[np.ndarray], label: np.ndarray, part: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between sets with different labels; of two parts, only links across them."""
    owners, starts, number, first = inverted(sets)
    size, several = np.diff(first), part[0] != part[-1]
    for a in range(len(sets)):
        if several and part[a] != part[0]:
            break
        other = label != label[a]
        other &= part != part[a] if several else np.arange(len(sets)) > a
        other &= 100 * np.minimum(size, size[a]) >= percent * np.maximum(size, size[a])
        if not other.any():
            continue
        mine = number[first[a]:first[a + 1]]
        lengths = starts[mine + 1] - starts[mine]
        place = np.arange(lengths.sum()) + np.repeat(starts[mine] - np.cumsum(lengths) + lengths, lengths)
        common = np.bincount(owners[place], minlength=len(sets))
        hits = np.flatnonzero(other & (100 * common >= percent * (size + size[a] - common)))
        for b in hits:
            if label[b] != label[a]:
                yield a, int(b)
                label[label == label[b]] = label[a]


def compare_units(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (cluster, i, j, p, root, node, chunk) come sorted; a unit is read whole, then compared."""
        unit, roots, parts, nodes, sets = None, [], [], [], []

        def links() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1:
                full = [np.concatenate(s) for s in sets]
                _, label = np.unique(np.array(roots), return_inverse=True)
                found = [(nodes[a], nodes[b]) for a, b in similar_links(full, label, np.array(parts), percent)]
                if found:
                    yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])

        for batch in batches:
            keys = [batch.column(k).to_pylist() for k in range(6)]
            chunks = batch.column(6)
            ends, flat = chunks.offsets.to_numpy(), chunks.values.to_numpy(zero_copy_only=False)
            for row, (cluster, i, j, p, root, node) in enumerate(zip(*keys)):
                if unit != (cluster, i, j):
                    yield from links()
                    unit, roots, parts, nodes, sets = (cluster, i, j), [], [], [], []
                if not nodes or nodes[-1] != node:
                    nodes.append(node), roots.append(root), parts.append(p), sets.append([])
                sets[-1].append(flat[ends[row]:ends[row + 1]].copy())
        yield from links()

    return compare


def rooted(nodes: DataFrame, links: DataFrame, name: str = "root") -> DataFrame:
    """The rows with the least node of their component in the graph of ``links``."""
    roots = star_forest(links).withColumnRenamed("root", "_root")
    of = roots.withColumnRenamed("node", "_node")
    return nodes.join(of, nodes["node"] == of["_node"], "left").select(nodes["*"], F.coalesce("_root", "node").alias(name))


def leading_candidates(candidates: DataFrame) -> DataFrame:
    """Per node of the candidates the partner that it meets most often, as a first pair to check."""
    times = candidates.groupBy("a", "b").count()
    return times.groupBy("a").agg(F.max_by("b", F.struct("count", -F.col("b"))).alias("b"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar; ``sets`` has rows (node, size, chunks). Meant for a few pairs per node."""
    of = lambda name: sets.select(F.col("node").alias(name), F.flatten("chunks").alias(f"of_{name}"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    sized = pairs.join(of("a"), "a").join(of("b"), "b")
    return sized.where(100 * common >= percent * (F.size("of_a") + F.size("of_b") - common)).select("a", "b")


def linked(nodes: DataFrame, candidates: DataFrame, sets: DataFrame, percent: int, rows: int = PART_ROWS, volume: int = PART_SHINGLES) -> DataFrame:
    """Links (a, b) that connect exactly what similar pairs within the candidates' components connect.

    ``nodes`` (node), ``candidates`` (a, b; repeated rows count as more shared evidence) and ``sets`` (node, size, chunks)
    are written tables; ``sets`` holds at least the nodes of candidates.
    """
    sure = materialize(verified(leading_candidates(candidates), sets, percent), "verified")
    known = materialize(rooted(nodes.select("node"), sure), "roots")
    root_of = lambda name: known.select(F.col("node").alias(name), F.col("root").alias(f"r_{name}"))
    between = candidates.select("a", "b").distinct().join(root_of("a"), "a").join(root_of("b"), "b")
    between = between.where("r_a <> r_b").select(F.col("r_a").alias("a"), F.col("r_b").alias("b"))
    clusters = star_forest(between).select(F.col("node").alias("root"), F.col("root").alias("cluster"))
    clusters = clusters.unionByName(clusters.select(F.col("cluster").alias("root"), "cluster").distinct())
    open_nodes = materialize(known.join(clusters, "root").join(sets.select("node", "size"), "node"), "open")

    weight = F.greatest(F.sum("size") / volume, F.count("*") / rows)
    by_root = open_nodes.groupBy("cluster", "root").agg(weight.alias("w"))
    of_cluster = by_root.groupBy("cluster").agg(F.max_by("root", F.struct("w", "root")).alias("main"), F.max("w").alias("w_main"), F.sum("w").alias("w_all"))
    parts = lambda w: F.greatest(F.ceil(w), F.lit(1)).cast("int")
    of_cluster = of_cluster.select("cluster", "main", parts(F.col("w_all") - F.col("w_main")).alias("n_others"), parts(F.col("w_main")).alias("n_main"))

    dealt = open_nodes.join(of_cluster, "cluster")
    spread = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    dealt = dealt.withColumn("p", F.when(F.col("root") == F.col("main"), F.col("n_others") + spread("n_main")).otherwise(spread("n_others")))
    last = F.when(F.col("p") < F.col("n_others"), F.col("n_others") + F.col("n_main") - 1).otherwise(F.col("n_others") - 1)
    units = F.transform(F.sequence(F.lit(0), last), lambda q: F.struct(F.least("p", q).alias("i"), F.greatest("p", q).alias("j")))
    unit = ["cluster", "u.i", "u.j", "p", "root", "node"]
    full = dealt.select("cluster", "p", "root", "node", F.explode(units).alias("u")).join(sets.select("node", "chunks"), "node")
    full = full.select(*unit, F.posexplode("chunks").alias("at", "chunk"))
    ordered = full.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "p", "node", "at")
    further = ordered.drop("at").mapInArrow(compare_units(percent), "a bigint, b bigint")
    return sure.unionByName(further)
