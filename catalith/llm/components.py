"""Connected components of an edge table.

Each round hooks every node to its smallest neighbour, follows the pointers to
their roots, and replaces the edges by edges between different roots.  Every node
with an edge loses its own root or gains one, so the edges that remain shrink by
half or more per round, and a round only reads what the last one left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.durable import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is the smallest node reachable."""
    e = _both_ways(edges)
    maps: list[DataFrame] = []
    while not e.isEmpty():
        p = e.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("root"))
        p = _to_roots(materialize(p, "hook"))
        maps.append(p)
        pa, pb = (p.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
        e = _both_ways(e.filter("a < b").join(pa, "a").join(pb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    out = maps[0]
    for later in maps[1:]:
        up = later.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        out = materialize(out.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root")), "comp")
    return out


def _both_ways(edges: DataFrame) -> DataFrame:
    kept = edges.filter("a <> b")
    turned = kept.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return materialize(kept.select("a", "b").unionByName(turned).distinct(), "edges")


def _to_roots(p: DataFrame) -> DataFrame:
    while True:
        up = p.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        q = materialize(p.join(up, "root").select("node", F.col("_up").alias("root"), (F.col("root") != F.col("_up")).alias("_moved")), "jump")
        if q.filter("_moved").isEmpty():
            return q.drop("_moved")
        p = q.drop("_moved")
