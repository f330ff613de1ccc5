"""Embedding near-duplicates by a forest of random-projection trees.

Identical vectors are folded first, so a vector that makes up a third of the rows
counts once (its copies link to each other without comparison).  Each tree splits
recursively at the median of a random projection; vectors near the split go to both
sides (spill).  Directions come from a hash of (tree, node); the medians and spill
margins are fitted on a bounded sample (``SAMPLE`` vectors), and every vector is
routed.  Where linked vectors of the sample make up much of a node (noisy copies of one
vector), a median would part them however close they are: the split is moved beside
them, and a node that cannot be split without parting them stays one leaf.  Levels follow from the row count, and trees from the levels, so that a pair
at the threshold shares a leaf in some tree with probability ``RECALL``.

Within a leaf all vectors are compared, in blocks: a leaf of more than ``BLOCK``
vectors becomes several groups, one per pair of blocks.  Cosines are taken in double
precision.  A pair that shares several leaves is counted in the first of them only,
which the task sees from the leaf lists its rows carry; so link counts are summed
without sending pairs, and each task returns a count and one star edge a vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.llm.common import attach, chosen, stored, whole
from catalith.llm.components import components
from catalith.llm.registry import query
from catalith.llm.simhash import Forest

THRESHOLD, RECALL = 0.9, 0.99
#: Vectors that fit the splits; vectors in a leaf; vectors compared in one group and side.
SAMPLE, LEAF, BLOCK = 20_000, 384, 1024
#: Share of a node's vectors that goes to both sides.
SPILL = 0.12
#: Chance that a pair at the threshold is parted by one split (angle / pi, less the spill).
PARTED = 0.11
#: A group is some linked sample vectors at least, with so many links of each; the share of a node that makes it large there.
GROUP, LINKS, SHARE = 8, 8, 0.25
#: Quantiles to split at, tried in this order.
PLACES = (0.5, 0.42, 0.58, 0.35, 0.65, 0.28, 0.72, 0.2, 0.8, 0.12, 0.88)
SEED = 7


def shape(n: int, sample: int, leaf: int = LEAF, recall: float = RECALL) -> tuple[int, int]:
    """Levels and trees for ``n`` vectors of which ``sample`` fit the splits."""
    levels = max(0, math.ceil(math.log2(max(1, n) / leaf)))
    levels = min(levels, max(0, int(math.log2(max(1, sample) / 8))))
    if not levels:
        return 0, 1
    return levels, math.ceil(math.log(1 - recall) / math.log(1 - (1 - PARTED) ** levels))


def direction(tree: int, node: int, dim: int) -> np.ndarray:
    return np.random.default_rng((SEED, tree, node)).standard_normal(dim)


def dense_groups(sample: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Group of every sample vector (-1: none of ``GROUP`` linked vectors or more) and some links ``(n, 2)`` within groups."""
    rng, x = np.random.default_rng(SEED), sample.astype(np.float32)
    forest, links = Forest(len(x)), [np.zeros((0, 2), dtype=np.int64)]
    for s in range(0, len(x), 512):
        near = x[s:s + 512] @ x.T >= threshold
        near[np.arange(len(near)), np.arange(s, s + len(near))] = False
        i, j = np.nonzero(near)
        forest.link(i + s, j)
        n = np.bincount(i, minlength=len(near))
        some = np.flatnonzero(n)
        at = (np.cumsum(n) - n)[some, None] + (rng.random((len(some), LINKS)) * n[some, None]).astype(np.int64)
        links.append(np.column_stack([np.repeat(some + s, LINKS), j[at.ravel()]]))
    _, label, size = np.unique(forest.roots(), return_inverse=True, return_counts=True)
    label = np.where(size[label] >= GROUP, label, -1)
    pairs = np.concatenate(links)
    return label, pairs[label[pairs[:, 0]] >= 0]


def cut(x: np.ndarray, label: np.ndarray, a: np.ndarray, b: np.ndarray, owner: np.ndarray, spill: float) -> tuple[float, float]:
    """Split points of projections ``x``: about the median, moved where that parts a group which makes up much of the node.

    ``a``, ``b``: projections of both ends of links, ``owner``: their groups.  Infinite
    (all go left, the node stays whole) when every place parts such a group too often.
    """
    large = np.flatnonzero(np.bincount(label[label >= 0]) >= max(GROUP, SHARE * len(x))) if (label >= 0).any() else ()
    for q in PLACES if len(large) else PLACES[:1]:
        low, high = np.quantile(x, [q - spill / 2, q + spill / 2])
        parted = (np.minimum(a, b) < low) & (np.maximum(a, b) > high)
        if all(parted[owner == g].mean() <= PARTED for g in large if (owner == g).any()):
            return low, high
    return np.inf, np.inf


def fit(sample: np.ndarray, levels: int, trees: int, spill: float = SPILL, threshold: float = THRESHOLD) -> np.ndarray:
    """Split points ``(trees, nodes, 2)``: vectors below the second go left, above the first right.

    Nodes are numbered as in a heap: 1 is the root, 2k and 2k + 1 are the children of k.
    A node that is to stay whole has infinite split points: all of it goes left, to the last level.
    """
    splits = np.zeros((trees, 1 << levels, 2))
    label, links = dense_groups(sample, threshold) if levels else (None, None)
    for t in range(trees):
        inside = {1: (np.arange(len(sample)), links)}
        for node in range(1, 1 << levels):
            rows, pairs = inside.pop(node)
            if not len(rows):
                inside[2 * node] = inside[2 * node + 1] = rows, pairs
                continue
            d = direction(t, node, sample.shape[1])
            x, (a, b) = sample[rows] @ d, (sample[pairs] @ d).T
            low, high = splits[t, node] = cut(x, label[rows], a, b, label[pairs[:, 0]], spill)
            inside[2 * node] = rows[x <= high], pairs[np.maximum(a, b) <= high]
            inside[2 * node + 1] = rows[x >= low], pairs[np.minimum(a, b) >= low]
    return splits


def route(x: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and leaves, ``(row, tree * leaves + leaf)`` for every leaf a row of ``x`` falls into; sorted by row."""
    trees, width, _ = splits.shape
    rows, leaves = [], []
    for t in range(trees):
        r, node = np.arange(len(x)), np.ones(len(x), dtype=np.int64)
        for _ in range(width.bit_length() - 1):
            order = np.argsort(node, kind="stable")
            r, node = r[order], node[order]
            p = np.empty(len(r))
            begins = np.flatnonzero(np.diff(node, prepend=-1))
            for a, b in zip(begins, [*begins[1:], len(r)]):
                p[a:b] = x[r[a:b]] @ direction(t, int(node[a]), x.shape[1])
            left, right = p <= splits[t, node, 1], p >= splits[t, node, 0]
            r, node = np.concatenate([r[left], r[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
        rows.append(r)
        leaves.append(t * width + node - width)
    row, leaf = np.concatenate(rows), np.concatenate(leaves)
    order = np.lexsort((leaf, row))
    return row[order], leaf[order]


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    # Scaled by the largest component first: the squares of huge or tiny ones would leave the range.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def compare(block: pa.Table, split: int | None, dim: int, leaf: int, threshold: float) -> pa.Table:
    """Counts and a star edge of the vectors of a block of a leaf, or (``split``) between its first rows and the rest.

    Returns ``(node, links, root)``: links counts, with copies, the partners whose first
    common leaf is this one.
    """
    x = _unit(block.column("v").combine_chunks(), dim)
    copies = block.column("copies").to_numpy()
    n, m = (len(x), 0) if split is None else (split, split)
    leaves = block.column("leaves").combine_chunks()
    row = np.repeat(np.arange(len(x)), leaves.value_lengths().to_numpy())
    other = leaves.flatten().to_numpy()
    row, other = row[other < leaf], other[other < leaf]
    names, at = np.unique(other, return_inverse=True)
    member = np.zeros((len(x), len(names)), dtype=bool)
    member[row, at] = True
    member = np.packbits(member, axis=1)
    links, forest = np.zeros(len(x), dtype=np.int64), Forest(len(x))
    for s in range(0, n, 128):
        near = x[s:min(s + 128, n)] @ x[m:].T >= threshold
        if split is None:
            near[np.arange(len(near)), np.arange(s, s + len(near))] = False
        i, j = np.nonzero(near)
        if not len(i):
            continue
        i, j = i + s, j + m
        forest.link(i, j)
        first = ~(member[i] & member[j]).any(axis=1)
        i, j = i[first], j[first]
        links += np.bincount(i, weights=copies[j], minlength=len(x)).astype(np.int64)
        if split is not None:
            links += np.bincount(j, weights=copies[i], minlength=len(x)).astype(np.int64)
    root = forest.roots()
    told = np.flatnonzero((links > 0) | (root != np.arange(len(root))))
    return pa.table({"node": block.column("node").take(pa.array(told)), "links": links[told], "root": block.column("node").take(pa.array(root[told]))})


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or empty, all components finite numbers, not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                 leaf: int = LEAF, block: int = BLOCK, recall: float = RECALL) -> DataFrame:
    """``(k, n_links, component)`` of every row of ``rows``.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing; nor do vectors of different lengths, or rows whose key is null.  Repeated
    rows count as often as they occur; other columns are not read.
    """
    table = rows.select(F.col(key).alias("k"), F.col(vector).alias("v"))
    table = table.withColumn("ok", usable(F.col("v")) & F.col("k").isNotNull())
    table = table.withColumn("digest", F.sha2(F.col("v").cast("string"), 256))
    good = table.filter("ok")
    nodes = materialize(good.groupBy("digest").agg(
        F.min("k").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")).select(
        "digest", "node", "copies", F.size("v").alias("dim"), "v"), "vectors")
    found: DataFrame | None = None
    dims = [(r["dim"], r["n"]) for r in nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()]
    for dim, n in sorted(dims):
        part = _leaf_links(nodes.filter(F.col("dim") == dim), dim, n, threshold, leaf, block, recall)
        found = part if found is None else found.unionByName(part)
    alone = table.filter("not ok").select("k", F.lit(0).cast("long").alias("n_links"), F.col("k").alias("component"))
    if found is None:
        return alone
    links = materialize(found.groupBy("node").agg(F.sum("links").alias("links")), "links")
    roots = components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.select("digest", "node", "copies").join(links, "node", "left").join(roots, "node", "left").select(
        "digest", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component"))
    named = materialize(named, "named")
    joined = attach(good.select("k", "digest"), named, "digest", "copies").select("k", "n_links", "component")
    return joined.unionByName(alone)


def _leaf_links(nodes: DataFrame, dim: int, n: int, threshold: float, leaf: int, block: int, recall: float) -> DataFrame:
    sample = chosen(nodes.select("node", "v"), F.col("node"), SAMPLE).select("v").toPandas()["v"]
    points = _unit(pa.array(list(sample), type=pa.list_(pa.float64())), dim) if len(sample) else np.zeros((0, dim))
    levels, trees = shape(n, len(points), leaf, recall)
    splits = fit(points, levels, trees, threshold=threshold)
    kind, vectors = (nodes.schema[c].dataType.simpleString() for c in ("node", "v"))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, at = route(_unit(b.column("v"), dim), splits)
            ends = np.searchsorted(row, np.arange(b.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(at, type=pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("copies"), b.column("v"), lists], names=["node", "copies", "v", "leaves"])

    placed = nodes.select("node", "copies", "v").mapInArrow(routed, f"node {kind}, copies long, v {vectors}, leaves array<long>")
    placed = stored(placed, "routed")
    # One row per leaf: bounded by trees and levels, and by SAMPLE.
    sizes = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    spread = (placed.withColumn("leaf", F.explode("leaves")).join(F.broadcast(materialize(sizes, "leaves")), "leaf")
              .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))

    def within(group: pa.Table) -> pa.Table:
        lo, hi, at = (group.column(c)[0].as_py() for c in ("lo", "hi", "leaf"))
        group = group.sort_by("node")
        if lo == hi:
            return compare(group, None, dim, at, threshold)
        own = group.column("own").to_numpy()
        order = np.argsort(own != lo, kind="stable")
        return compare(group.take(pa.array(order)), int((own == lo).sum()), dim, at, threshold)

    return materialize(spread.groupBy("leaf", "lo", "hi").applyInArrow(within, f"node {kind}, links long, root {kind}"), "compared")


@query("op4_embedding_dups")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    rows = near_vectors(whole(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id", "embedding"))
    return rows.select(F.col("k").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                       F.col("k").eqNullSafe(F.col("component")).alias("kept"))
