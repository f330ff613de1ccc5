"""Near copies by Jaccard similarity of word shingles: MinHash bands, true similarity on the candidates.

Two texts are linked when the sets of their five-word shingles have a Jaccard similarity
of ``LEAST`` or more.  A pair becomes a candidate when one of ``BANDS`` bands of ``ROWS``
minima agrees: at similarity 0.8 with probability 0.9993, at 0.9 with more than 1 - 1e-8.
(A SimHash of 64 bits differs in about 10 bits at 0.8, so its budget had to be about 17
bits for the same recall, where the trie join prunes hardly anything.)

Texts with the same words are folded first.  Every member of a bucket is then compared
with its smallest one, which joins a hot bucket without pairs.  Buckets that still hold
several components are compared further, whole: the members outside the largest
component with all others, in blocks.  No candidate is left out, and links are those
of the true similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.layout import shuffle_join
from catalith.llm.common import attach, settings, stored, text_hash
from catalith.llm.components import components
from catalith.llm.simhash import Forest, fingerprint_table, link_stars, shingle_hashes

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 24, 6
#: Members of a bucket, and characters of their texts, compared in one group and side.
BLOCK, BLOCK_CHARS = 256, 4 << 20
#: Pairs that share one copy of the text of a bucket's smallest member.
PAIRS_PER_COPY = 1000
#: Rows of two texts each, or of one, handed to a Python worker at once.
PAIRS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}

_RNG = np.random.default_rng(11)
_TIMES = _RNG.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles of a text, ascending."""
    return np.unique(np.array(shingle_hashes(text, words), dtype=np.uint64))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two shingle sets; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def band_hashes(shingles: np.ndarray) -> np.ndarray:
    """One hash per band, different between bands; none for the empty set."""
    if not len(shingles):
        return np.zeros(0, dtype=np.int64)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, dtype=np.uint32)
    for s in range(0, len(short), 1024):
        x = short[None, s:s + 1024] * _TIMES
        x += _PLUS
        np.minimum(least, x.min(axis=1), out=least)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(least.reshape(BANDS, ROWS))], dtype=np.uint64).view(np.int64)


def _table(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    rows = docs.select(F.col(key).alias("k"), text_hash(F.col(text)).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("t").to_pylist()
            same = np.array([xxhash.xxh64_intdigest(b" ".join(t.encode().lower().split())) for t in texts], dtype=np.uint64).view(np.int64)
            bands = pa.array([band_hashes(shingle_set(t, words)) for t in texts], type=pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("h"), pa.array(same), bands], names=["k", "h", "node", "bands"])

    return rows.mapInArrow(hashed, f"k {kind}, h long, node long, bands array<long>")


def _linked(pairs: DataFrame, words: int, least: float) -> DataFrame:
    """The ``(a, b)`` of ``pairs(a, b, ta, tb)`` whose texts are similar."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(maxsize=512)(lambda t: shingle_set(t, words))
        for b in batches:
            ok = [similarity(known(x), known(y)) >= least for x, y in zip(b.column("ta").to_pylist(), b.column("tb").to_pylist())]
            yield b.select(["a", "b"]).filter(pa.array(ok, type=pa.bool_()))

    return pairs.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def compare(group: pa.Table, words: int, least: float) -> pa.Table:
    """Star edges among the members of a group; only pairs with a member off the largest component are compared."""
    node, root = group.column("node").to_numpy(), group.column("root").to_numpy()
    rest = np.flatnonzero(group.column("rest").to_numpy(zero_copy_only=False))
    sets = [shingle_set(t, words) for t in group.column("t").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    names, at = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    forest = Forest(len(node))
    for i in rest.tolist():
        mark = np.zeros(len(names), dtype=np.int64)
        mark[at[begins[i]:begins[i] + sizes[i]]] = 1
        both = np.add.reduceat(mark[at], begins)
        j = np.flatnonzero((both / (sizes + sizes[i] - both) >= least) & (root != root[i]))
        forest.link(np.full(len(j), i), j)
    leaves, roots = forest.stars()
    return pa.table({"a": node[leaves], "b": node[roots]})


def fingerprint_links(docs: DataFrame, table: DataFrame, budget: int, text: str = "text") -> DataFrame:
    """Edges ``(a, b)`` between the nodes of ``table(h, node)`` whose SimHash fingerprints differ in ``budget`` bits or fewer.

    Of each fingerprint the smallest node takes part in the trie join; the others are linked with it.
    """
    prints = fingerprint_table(docs.select(F.lit(0).alias("k"), F.col(text).alias("t")), "k", "t").select("h", "fp").distinct()
    known = materialize(shuffle_join(table.select("h", "node").distinct(), prints, ["h"]).select("node", "fp").distinct(), "prints")
    first = materialize(known.groupBy("fp").agg(F.min("node").alias("first")), "first-prints")
    same = shuffle_join(known, first, ["fp"]).filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    stars = materialize(link_stars(first.select("fp"), budget), "stars")
    ends = [first.select(F.col("fp").alias(c), F.col("first").alias(f"_{c}")) for c in ("a", "b")]
    near = shuffle_join(shuffle_join(stars, ends[0], ["a"]), ends[1], ["b"]).select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    return materialize(same.unionByName(near), "print-links")


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, least: float = LEAST,
                   block: int = BLOCK, budget: int | None = None) -> DataFrame:
    """``(k, h, component)`` of every row; ``component`` is the smallest key reachable by links.

    Texts with the same words in the same order (A-Z lower-cased) are linked, so all texts
    without a word are.  With a ``budget`` so are texts whose SimHash fingerprints differ in that
    many bits or fewer.  A null key is above all others.
    """
    table = stored(_table(docs, key, text, words), "bands")
    nodes = materialize(table.groupBy("node").agg(
        F.min("k").alias("least"), F.count(F.lit(1)).alias("n"), F.min("h").alias("h"), F.first("bands").alias("bands")), "nodes")
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = materialize(rows.groupBy("bucket").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("m")).filter("m > 1"), "buckets")
    placed = materialize(attach(rows, buckets, "bucket", "m").select("bucket", "node", "first", "m"), "placed")
    hashed = docs.select(text_hash(F.col(text)).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    wanted = placed.select("node").distinct().join(nodes.select("node", "h"), "node")
    texts = materialize(hashed.join(wanted, "h").groupBy("node").agg(F.min("t").alias("t")), "texts")

    pairs = placed.filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    pairs = materialize(pairs, "pairs")
    # A first that many members share is copied, so its text meets a bounded number of them in one task and none is broadcast.
    uses = materialize(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("u")), "firsts")
    copies = F.ceil(F.col("u") / PAIRS_PER_COPY).cast("int")
    firsts = uses.join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b").select(
        "b", "tb", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    dealt = attach(pairs, uses, "b", "u").select("a", "b", F.pmod(F.xxhash64("a"), copies).cast("int").alias("copy"))
    both = dealt.join(firsts, ["b", "copy"]).join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")
    with settings(docs.sparkSession, PAIRS):
        edges = materialize(_linked(both, words, least), "links")
    more = _within(placed, components(edges), texts, words, least, block)
    links = edges.unionByName(more)
    roots = components(links if budget is None else links.unionByName(fingerprint_links(docs, table, budget, text)))

    named = nodes.join(roots, "node", "left").select("node", "least", "n", F.coalesce("root", "node").alias("root"))
    named = materialize(named, "named")
    smallest = named.groupBy("root").agg(F.min("least").alias("component"), F.sum("n").alias("_m"))
    final = materialize(attach(named, smallest, "root", "_m").select("node", "n", "component"), "classes")
    return attach(table.select("k", "h", "node"), final, "node", "n").select("k", "h", "component")


def _within(placed: DataFrame, roots: DataFrame, texts: DataFrame, words: int, least: float, block: int) -> DataFrame:
    """Edges between different components of the same bucket; ``placed(bucket, node, first, m)``."""
    # Two members were compared with each other already.
    sizes = texts.select("node", F.length("t").alias("chars"))
    rows = placed.filter("m > 2").join(roots, "node", "left").join(sizes, "node").select(
        "bucket", "node", "chars", F.coalesce("root", "node").alias("root"))
    rows = materialize(rows, "rooted")
    parts = rows.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("chars").alias("chars"))
    alive = parts.groupBy("bucket").agg(F.max(F.struct("c", "root", "chars")).alias("main"), F.sum("c").alias("m"), F.sum("chars").alias("chars"),
                                        F.count(F.lit(1)).alias("parts")).filter("parts > 1")

    def blocks(members: Column, chars: Column) -> Column:
        return F.greatest(F.ceil(members / block), F.ceil(chars / BLOCK_CHARS)).cast("int")

    alive = materialize(alive.select("bucket", F.col("main.root").alias("main"), "m", blocks(F.col("main.c"), F.col("main.chars")).alias("mains"),
                                     blocks(F.col("m") - F.col("main.c"), F.col("chars") - F.col("main.chars")).alias("rests")), "alive")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("mains"))).cast("int")
    dealt = attach(rows, alive, "bucket", "m").withColumn("rest", F.col("root") != F.col("main")).withColumn("own", own)
    # Blocks off the main component meet each other and every block of it; lo < 0 counts the latter's blocks.
    off = F.concat(F.transform(F.sequence(F.lit(0), F.col("rests") - 1), lambda x: F.struct(F.least("own", x).alias("lo"), F.greatest("own", x).alias("hi"))),
                   F.transform(F.sequence(F.lit(1), F.col("mains")), lambda x: F.struct((-x).alias("lo"), F.col("own").alias("hi"))))
    main = F.transform(F.sequence(F.lit(0), F.col("rests") - 1), lambda x: F.struct((-F.col("own") - 1).alias("lo"), x.alias("hi")))
    spread = dealt.withColumn("at", F.explode(F.when(F.col("rest"), off).otherwise(main))).select("bucket", "at.lo", "at.hi", "node", "root", "rest")
    spread = spread.join(texts, "node")
    return materialize(spread.groupBy("bucket", "lo", "hi").applyInArrow(lambda g: compare(g, words, least), "a long, b long"), "within")
