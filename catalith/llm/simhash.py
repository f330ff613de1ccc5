"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Only distinct fingerprints take part, so a text that makes up a third of the input
counts once.  The join walks pairs of trie nodes together from the root, adds a bit
whenever a pair takes different branches, and drops the pair once the bits exceed
the budget.  It starts on the driver over the trie cut at nodes of about ``leaf``
fingerprints (their counts only, ``TABLE`` at a time), which gives the pairs of leaves
that can hold links; each pair is one task's group, where the walk goes on down to
single fingerprints.  A node with many fingerprints is cut deeper before that, so a
dense spot of the space is spread like any other.

Tasks return a spanning star per linked set, never all links; components of these
stars are those of the links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.llm.common import attach, single, stored, text_hash, whole, without
from catalith.llm.components import components
from catalith.llm.registry import query

BITS, BUDGET, WORDS = 64, 2, 3
#: Fingerprints in a leaf of the cut trie, and the most leaves a table without dense spots gets.
LEAF, LEAVES = 2048, 1 << 14
#: Most bits by which the cut goes deeper at a time, and most counts the driver gets for that.
STEP, TABLE = 12, 1 << 17
#: Node pairs or candidate pairs a task holds at once.
AT_ONCE = 1 << 20


def shingle_hashes(text: str, words: int = WORDS) -> list[int]:
    """XXH64 (seed 42) of every shingle: A-Z lower-cased, words between ASCII white space, repeats included."""
    found = text.encode().lower().split()
    if not found:
        return []
    h, joined = xxhash.xxh64_intdigest, b" ".join(found)
    if len(found) <= words:
        return [h(joined, 42)]
    ends, at = [], -1
    for w in found:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    return [h(joined[s:e], 42) for s, e in zip(starts, ends[words - 1:])]


def fingerprints(texts: list[str], words: int = WORDS) -> np.ndarray:
    """A bit is set if over half of the text's shingle hashes have it; no word gives 0."""
    out, part, sizes, first = np.zeros(len(texts), dtype=np.uint64), [], [], 0

    def settle(upto: int) -> None:
        nonlocal part, sizes, first
        n = np.array(sizes, dtype=np.int64)
        if part:
            bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            full = np.flatnonzero(n)
            begins = (np.cumsum(n) - n)[full]
            ones = np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
            packed = np.packbits((2 * ones > n[full, None]).astype(np.uint8), axis=1, bitorder="little")
            out[first + full] = np.ascontiguousarray(packed).view("<u8")[:, 0]
        part, sizes, first = [], [], upto

    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, words)
        part += hashes
        sizes.append(len(hashes))
        if len(part) > AT_ONCE // 8:
            settle(i + 1)
    settle(len(texts))
    return out


def fingerprint_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(k, h, fp)`` of every row: key, text hash, fingerprint as a signed long."""
    rows = docs.select(F.col(key).alias("k"), text_hash(F.col(text)).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprints(b.column("t").to_pylist()).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("h"), pa.array(fp)], names=["k", "h", "fp"])

    return rows.mapInArrow(hashed, f"k {kind}, h long, fp long")


def joined_pairs(a: np.ndarray, b: np.ndarray, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Walk the tries of two sorted arrays of distinct uint64 together; index pairs within ``budget`` bits.

    Pass the same array twice for a self-join: each pair then comes once.
    """
    same = a is b
    todo = [(np.array([[0, len(a), 0, len(b), 0]], dtype=np.int64), BITS - 1)] if len(a) and len(b) else []
    while todo:
        nodes, level = todo.pop()
        if len(nodes) > AT_ONCE:
            half = len(nodes) // 2
            todo += [(nodes[:half], level), (nodes[half:], level)]
            continue
        small = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= (16 if level >= 0 else np.iinfo(np.int64).max)
        yield from _compared(a, b, nodes[small], budget, same)
        nodes = nodes[~small]
        if not len(nodes):
            continue
        (la, ha, lb, hb, d), bit = nodes.T, np.uint64(1 << level)
        ma, mb = ha - _ones(a, bit, la, ha), hb - _ones(b, bit, lb, hb)
        own = (la == lb) & (ha == hb) if same else np.zeros(len(nodes), dtype=bool)
        more = d < budget
        children = np.concatenate([
            np.column_stack([la, ma, lb, mb, d]), np.column_stack([ma, ha, mb, hb, d]),
            np.column_stack([la, ma, mb, hb, d + 1])[more], np.column_stack([ma, ha, lb, mb, d + 1])[more & ~own]])
        todo.append((children[(children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3])], level - 1))


def _ones(x: np.ndarray, bit: np.uint64, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum((x & bit) != 0)))
    return total[hi] - total[lo]


def _compared(a: np.ndarray, b: np.ndarray, nodes: np.ndarray, budget: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    wide = nodes[:, 3] - nodes[:, 2]
    size = (nodes[:, 1] - nodes[:, 0]) * wide
    ends = np.cumsum(size)
    start = 0
    while start < len(nodes):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + AT_ONCE, side="right")))
        n = size[start:stop]
        row = np.repeat(np.arange(start, stop), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i, j = nodes[row, 0] + k // wide[row], nodes[row, 2] + k % wide[row]
        ok = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            ok &= i < j
        yield i[ok], j[ok]
        start = stop


class Forest:
    """Smallest label of each linked set, fed with links bit by bit."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            self.root = self.roots()
            x, y = self.root[i], self.root[j]
            open_ = x != y
            i, j, x, y = i[open_], j[open_], x[open_], y[open_]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))

    def roots(self) -> np.ndarray:
        root = self.root
        while not np.array_equal(up := root[root], root):
            root = up
        return root

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        root = self.roots()
        leaves = np.flatnonzero(root != np.arange(len(root)))
        return leaves, root[leaves]


def cut_trie(nodes: DataFrame, leaf: int, step: int = STEP) -> list[tuple[int, int]]:
    """The cut as ``(prefix, depth)``, in order, covering all fingerprints; nodes below hold ``leaf`` or about.

    The more nodes are still too full, the fewer bits a round goes deeper: it collects
    ``TABLE`` counts at most (at most ``LEAVES`` nodes can be too full, as ``leaf`` grows with the input).
    """
    cut: list[tuple[int, int]] = []
    open_: list[int] = [0]  # prefixes of length ``depth`` that hold too many
    depth = 0
    while open_:
        deep = min(BITS, depth + max(1, min(step, (TABLE // len(open_)).bit_length() - 1)))
        shift = BITS - deep
        prefix = F.shiftrightunsigned("fp", shift) if shift else F.col("fp")
        rows = nodes
        if depth:
            wanted = nodes.sparkSession.createDataFrame([(_signed(p, depth),) for p in open_], "_p long")
            rows = nodes.withColumn("_p", F.shiftrightunsigned("fp", BITS - depth)).join(F.broadcast(wanted), "_p", "left_semi")
        counts = {r["p"] & ((1 << deep) - 1): r["n"] for r in rows.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
        sums = [counts]
        for _ in range(deep - depth):
            up: dict[int, int] = {}
            for p, n in sums[-1].items():
                up[p >> 1] = up.get(p >> 1, 0) + n
            sums.append(up)
        sums.reverse()  # sums[k]: counts at depth + k
        again: list[int] = []
        todo = [(p, 0) for p in open_]
        while todo:
            p, k = todo.pop()
            n = sums[k].get(p, 0)
            if n <= leaf or depth + k == BITS:
                if n:
                    cut.append((p, depth + k))
            elif k == deep - depth:
                again.append(p)
            else:
                todo += [(2 * p, k + 1), (2 * p + 1, k + 1)]
        open_, depth = again, deep
    return sorted(cut, key=lambda x: x[0] << (BITS - x[1]))


def _signed(p: int, bits: int) -> int:
    return p - (1 << 64) if bits == BITS and p >> 63 else p


def leaf_pairs(cut: list[tuple[int, int]], budget: int = BUDGET) -> list[tuple[int, int]]:
    """Pairs of leaves (by place in ``cut``, smaller first) whose prefixes differ in ``budget`` bits or fewer."""
    below: set[tuple[int, int]] = set()
    index = {x: i for i, x in enumerate(cut)}
    for p, d in cut:
        while (p, d) not in below:
            below.add((p, d))
            if not d:
                break
            p, d = p >> 1, d - 1
    out, todo = [], [((0, 0), (0, 0), 0)] if cut else []
    while todo:
        a, b, bits = todo.pop()
        if a not in below or b not in below:
            continue
        ia, ib = index.get(a), index.get(b)
        if ia is not None and ib is not None:
            out.append((min(ia, ib), max(ia, ib)))
            continue
        ka = [a] if ia is not None else [(2 * a[0], a[1] + 1), (2 * a[0] + 1, a[1] + 1)]
        kb = [b] if ib is not None else [(2 * b[0], b[1] + 1), (2 * b[0] + 1, b[1] + 1)]
        if a == b:
            todo += [(ka[0], ka[0], bits), (ka[1], ka[1], bits)]
            if bits < budget:
                todo.append((ka[0], ka[1], bits + 1))
            continue
        for x in ka:
            for y in kb:
                # Where one side is a leaf already, its next bit is not known yet.
                differ = len(ka) == len(kb) and (x[0] ^ y[0]) & 1
                if bits + differ <= budget:
                    todo.append((x, y, bits + differ))
    return sorted(set(out))


def link_stars(nodes: DataFrame, budget: int = BUDGET, leaf: int = LEAF) -> DataFrame:
    """Edges ``(a, b)`` between fingerprints of ``nodes(fp)`` whose components are those of all links."""
    leaf = max(leaf, nodes.count() // LEAVES)
    cut = cut_trie(nodes, leaf)
    pairs = leaf_pairs(cut, budget)
    starts = np.array([p << (BITS - d) for p, d in cut], dtype=np.uint64)
    groups: list[list[int]] = [[] for _ in cut]
    for g, (i, j) in enumerate(pairs):
        groups[i].append(2 * g)
        if j != i:
            groups[j].append(2 * g + 1)
    counts = np.array([len(g) for g in groups], dtype=np.int64)
    flat = np.array([g for gs in groups for g in gs], dtype=np.int64)
    begins = np.cumsum(counts) - counts

    def spread_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy()
            at = np.searchsorted(starts, fp.view(np.uint64), side="right") - 1
            n = counts[at]
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            g = flat[np.repeat(begins[at], n) + k]
            yield pa.RecordBatch.from_arrays([pa.array(g >> 1), pa.array((g & 1).astype(np.int32)), pa.array(np.repeat(fp, n))], names=["pair", "side", "fp"])

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        fp, side = group["fp"].to_numpy().view(np.uint64), group["side"].to_numpy()
        a, b = np.sort(fp[side == 0]), np.sort(fp[side == 1])
        own = pairs_are_own[int(group["pair"].iloc[0])]
        both = a if own else np.concatenate([a, b])
        forest = Forest(len(both))
        for i, j in joined_pairs(a, a if own else b, budget):
            forest.link(i, j if own else j + len(a))
        leaves, roots = forest.stars()
        return pd.DataFrame({"a": both[leaves].view(np.int64), "b": both[roots].view(np.int64)})

    pairs_are_own = np.array([i == j for i, j in pairs], dtype=bool)
    spread_rows = nodes.select("fp").mapInArrow(spread_out, "pair long, side int, fp long")
    return spread_rows.groupBy("pair").applyInPandas(walk, "a long, b long")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", budget: int = BUDGET, leaf: int = LEAF) -> DataFrame:
    """``(k, h, fp, component)`` of every row; ``component`` is the smallest key reachable by links.

    Texts without a word have fingerprint 0 and link like others.  A null key is above
    all others (``component`` is null only if no row of the component has one).
    Repeated rows share their fingerprint.  Columns other than key and text are not read.
    """
    table = stored(fingerprint_table(docs, key, text), "fingerprints")
    nodes = materialize(table.groupBy("fp").agg(F.min("k").alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    edges = materialize(link_stars(nodes, budget, leaf), "stars")
    roots = components(edges)
    named = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    named = materialize(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component"), F.sum("n").alias("members"))
    final = materialize(attach(named, least.withColumnRenamed("members", "_m"), "root", "_m").select("fp", "n", "component"), "classes")
    return attach(table, final, "fp", "n").select("k", "h", "fp", "component")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, key: str = "doc_id", groups: Callable[[DataFrame, str], DataFrame] = near_groups) -> DataFrame:
    """``docs`` with the row of the smallest key of each component of ``groups``; of rows that repeat it, one."""
    table = materialize(groups(docs, key), "near")
    stays = F.col("k").eqNullSafe(F.col("component"))
    kept = without(docs, table.filter(~stays), key)
    twice = table.filter(stays).groupBy(F.col("component").alias("_catalith_k")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    return single(kept, materialize(twice, "twice"), F.col(key).eqNullSafe(F.col("_catalith_k")))


@query("op3_simhash")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = whole(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text")
    rows = near_groups(docs)
    return rows.select(F.col("k").alias("doc_id"), hex_digits(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))
