"""Exact nearest neighbours that read only the cells that can still matter.

The corpus is stored once, clustered by the nearest of at most ``CELLS`` centres.  Angles
between unit vectors obey the triangle inequality, so a cell whose rows lie between the
angles ``lo`` and ``hi`` from its centre holds nothing nearer to a query than the distance of
the query's own angle from that range.  A cell is left out when even that bound does not
reach the k-th score found so far, and no pair that belongs to the result is lost.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.layout import dense_row_number
from catalith.operators.retrieval import _best, _unit

# Python workers receive these helpers by value (no installed copy needed).
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[_best.__module__])

CELLS = 256
#: Vectors that travel to every task (centres, one block of queries) take at most so many bytes.
SHARED_BYTES = 16 << 20
QUERY_ROWS = 2_048
# Cosines and their angles are computed in double precision; bounds give way by this much.
SLACK = 1e-6


@dataclass(frozen=True)
class Cells:
    """A stored corpus: its rows by cell, the centres, and one ``(lo, hi, rows)`` per (space, cell)."""

    rows: DataFrame
    centres: dict[str, np.ndarray]
    reach: dict[tuple[str, int], tuple[float, float, int]]


@dataclass(frozen=True)
class Found:
    """``rows(query_id, id, score, rank)`` with the number of compared pairs, and of all there are."""

    rows: DataFrame
    compared: int
    pairs: int


def _space(df: DataFrame, key: str) -> DataFrame:
    """Rows that can score, with their space: vectors of different models or lengths never meet."""
    size = F.size("vec")
    ok = F.col(key).isNotNull() & F.col("model").isNotNull() & (size > 0) & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x))
    return df.filter(F.coalesce(ok, F.lit(False))).select(
        F.col(key), F.concat(size.cast("string"), F.lit(":"), F.col("model").cast("string")).alias("space"), "vec")


def _rows_for(dim: int, most: int) -> int:
    return max(1, min(most, SHARED_BYTES // (8 * max(1, dim))))


def _nearest(df: DataFrame, key: str, centres: dict[str, np.ndarray]) -> DataFrame:
    """Adds the nearest centre (-1 in a space without one), the angle to it and a running slot; drops vectors without direction."""
    shared = df.sparkSession.sparkContext.broadcast(centres)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = 0
        for pdf in batches:
            for space, g in pdf.groupby("space"):
                v = _unit(g["vec"])
                c = shared.value.get(space)
                if c is None:
                    cell, angle = np.full(len(g), -1), np.zeros(len(g))
                else:
                    s = v @ c.T
                    cell = np.argmax(s, axis=1)
                    angle = np.arccos(np.clip(s[np.arange(len(g)), cell], -1, 1))
                out = g.assign(cell=cell.astype("int32"), angle=angle, slot=np.arange(seen, seen + len(g)))
                seen += len(g)
                yield out[np.isfinite(v).all(axis=1)]

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = f"{key} {kinds[key]}, space string, vec {kinds['vec']}, cell int, angle double, slot long"
    return df.select(key, "space", "vec").mapInPandas(place, schema)


def build_cells(corpus: DataFrame, cells: int = CELLS) -> Cells:
    """Store ``corpus(id, model, vec)`` by cell.

    Centres are a sample of at most ``cells`` rows (the smallest hashes, bounded in bytes as well); every row
    is stored.  Rows with a null id or model, and vectors that are null, empty, zero or hold null or non-finite
    components, take no part.  A cell with a third of all rows is spread over many files, since the range
    partitions go on from the cell to the row.
    """
    rows = _space(corpus.select("id", "model", "vec"), "id")
    dim = rows.agg(F.max(F.size("vec"))).first()[0] or 1
    picked = (rows.orderBy(F.xxhash64("space", "vec"), F.xxhash64("id")).limit(_rows_for(dim, cells)).toPandas())
    centres = {}
    for space, g in picked.groupby("space"):
        c = np.unique(_unit(g["vec"]), axis=0)
        if len(c := c[np.isfinite(c).all(axis=1)]):
            centres[space] = c
    placed = materialize(_nearest(rows, "id", centres), "placed")
    # Spaces without a centre share cell -1, whose bound never excludes it: at most one row here per centre and one more.
    known = F.when(F.col("cell") >= 0, F.col("space")).otherwise(F.lit(""))
    reach = {(r.s, r.cell): (r.lo, r.hi, r.n) for r in placed.groupBy(known.alias("s"), "cell").agg(
        F.min("angle").alias("lo"), F.max("angle").alias("hi"), F.count(F.lit(1)).alias("n")).collect()}
    stored = materialize(placed.repartitionByRange("cell", "space", "slot", F.hash("id")).sortWithinPartitions("cell", "space").drop("slot", "angle"),
                         "cells", by=["cell"])
    return Cells(stored, centres, reach)


def pruned_knn(queries: DataFrame, cells: Cells, k: int, query_rows: int = QUERY_ROWS) -> Found:
    """The k best rows per query by cosine, ties by id: the result of ``retrieval.knn``, from fewer comparisons.

    ``queries(query_id, model, vec)`` with ``query_id`` as key; rows that cannot score (see ``build_cells``) get no
    result.  Queries of near cells share a block.  Each block of at most ``query_rows`` (and ``SHARED_BYTES``)
    travels to the stored corpus, which is neither shuffled nor copied: a first job reads the cells nearest to
    its queries, a second the cells that can still hold something better.  Both list their cells as partitions.
    """
    spark = queries.sparkSession
    asked = _space(queries.select("query_id", "model", "vec"), "query_id")
    dim = asked.agg(F.max(F.size("vec"))).first()[0] or 1
    size = _rows_for(dim, query_rows)
    numbered = dense_row_number(_nearest(asked, "query_id", cells.centres).drop("slot", "angle"),
                                ["space", "cell", "query_id"], "no")
    numbered = materialize(numbered.withColumn("block", F.floor((F.col("no") - 1) / size).cast("int")), "asked", by=["block"])
    blocks = (numbered.agg(F.max("block")).first()[0] + 1) if numbered.take(1) else 0
    kinds = {"query_id": dict(queries.dtypes)["query_id"], "id": dict(cells.rows.dtypes)["id"]}
    schema = f"query_id {kinds['query_id']}, id {kinds['id']}, score double"
    parts, compared, pairs = [], 0, 0
    for b in range(blocks):
        block = numbered.filter(F.col("block") == b).toPandas()
        found, n, of = _search(cells, block, k, schema)
        parts.append(found)
        compared, pairs = compared + n, pairs + of
    rows = parts[0] if parts else spark.createDataFrame([], schema)
    for p in parts[1:]:
        rows = rows.unionAll(p)
    return Found(_top(rows, k), compared, pairs)


def _top(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "id")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _search(cells: Cells, block: pd.DataFrame, k: int, schema: str) -> tuple[DataFrame, int, int]:
    """Candidates of one block of queries that contain its k best, with compared and possible pairs."""
    asked, bound = {}, {}
    for space, g in block.groupby("space"):
        q = _unit(g["vec"])
        asked[space] = (g["query_id"].to_numpy(), q)
        own = [c for s, c in cells.reach if s == space]
        if own:
            angle = np.arccos(np.clip(q @ cells.centres[space][own].T, -1, 1))
            lo, hi, n = (np.array(x) for x in zip(*[cells.reach[space, c] for c in own], strict=True))
            gap = np.maximum(np.maximum(angle - hi, lo - angle), 0)
            bound[space] = (own, n, np.cos(gap) + SLACK)
    loose = ("", -1) in cells.reach
    # First: per query its best bounded cells until they hold k rows.
    first: dict[str, dict[int, np.ndarray]] = {}
    for space, (own, n, top) in bound.items():
        order = np.argsort(-top, axis=1, kind="stable")
        before = np.cumsum(n[order], axis=1) - n[order]
        mask = np.zeros_like(top, dtype=bool)
        np.put_along_axis(mask, order, before < k, axis=1)
        first[space] = {c: mask[:, j] for j, c in enumerate(own) if mask[:, j].any()}
    near = materialize(_scan_cells(cells, asked, first, k, schema, None), "near")
    kth = {r.query_id: r.s for r in _top(near, k).groupBy("query_id").agg(
        F.min("score").alias("s"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).collect()}
    second: dict[str, dict[int, np.ndarray]] = {}
    least = {}
    for space, (ids, _) in asked.items():
        least[space] = np.array([kth.get(i, -np.inf) for i in ids.tolist()])
        if space in bound:
            own, _, top = bound[space]
            more = top >= least[space][:, None]
            second[space] = {c: m for j, c in enumerate(own)
                             if (m := more[:, j] & ~first[space].get(c, np.zeros(len(ids), dtype=bool))).any()}
        elif loose:
            second[space] = {-1: np.ones(len(ids), dtype=bool)}
    rest = materialize(_scan_cells(cells, asked, second, k, schema, least), "rest")
    n_of = lambda s, c: cells.reach[("" if c < 0 else s), c][2]
    compared = sum(int(m.sum()) * n_of(s, c) for step in (first, second) for s, by in step.items() for c, m in by.items())
    pairs = sum(len(ids) * sum(n for (s, _), (_, _, n) in cells.reach.items() if s in (space, "")) for space, (ids, _) in asked.items())
    return near.unionAll(rest), compared, pairs


def _scan_cells(cells: Cells, asked: dict, wanted: dict, k: int, schema: str, least: dict | None) -> DataFrame:
    """k best per query and batch among the cells wanted for it; with ``least`` only scores that reach it."""
    listed = sorted({c for by in wanted.values() for c in by})
    shared = cells.rows.sparkSession.sparkContext.broadcast((asked, wanted, least))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, wanted, least = shared.value
        for pdf in batches:
            for (space, cell), g in pdf.groupby(["space", "cell"]):
                mask = wanted.get(space, {}).get(int(cell))
                if mask is None:
                    continue
                ids, q = asked[space]
                out = _best(ids[mask], q[mask], g["id"].to_numpy(), _unit(g["vec"]), k)
                if least is not None:
                    out = out[out["score"].to_numpy() >= np.repeat(least[space][mask], min(k, len(g))) - SLACK]
                yield out

    return cells.rows.filter(F.col("cell").isin(listed)).select("id", "space", "vec", "cell").mapInPandas(scan, schema)
