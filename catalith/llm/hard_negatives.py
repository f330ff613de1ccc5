"""Hard negatives by threshold joins over an inverted index with norm bounds.

A row's score for an anchor is the inner product of their integer vectors.  Positives are
an anchor's best rows of its own label; for each positive, the negatives are the best rows
of other labels within a window below the positive's score.

Every task indexes its rows in chunks.  A row's components are ranked by magnitude; at a
threshold, the smallest components whose norm (the suffix norm of that ranking) cannot reach
it with any anchor are left out of the posting lists.  Partial scores are accumulated
posting list by posting list; a pair goes on only while its partial score plus the product
of the norms that remain on both sides can reach the threshold, and what is left is
scored exactly in integers.  Anchors whose windows are full at that threshold are done with
the chunk; for the others the threshold is lowered, and the lists grow by the components
then needed, down to a floor no result can lie under: the window's own lower end, or the
worst score a task has kept so far.  A task hands on at most ``PICK`` rows a window, which
one aggregation merges.

Anchors are a stated query set: they are taken in blocks bounded in bytes (``BLOCK_BYTES``),
each broadcast to one pass over the rows, so rows are never copied nor shuffled, and a label
or a spot of near copies that holds a third of all rows is only so many rows of a scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalith.durable import scratch_root
from catalith.llm.common import stored, whole
from catalith.llm.registry import query

#: Positives of an anchor; negatives of a positive.
PICK = 5
#: A negative scores from LOW to HIGH hundredths of its positive.
LOW, HIGH = 80, 100
#: Bytes of anchor vectors broadcast at once; rows indexed at once; anchors compared with them at once.
BLOCK_BYTES, CHUNK, SIDE = 8 << 20, 2048, 256
#: Thresholds as cosines, tried downwards; the floor comes last.
LEVELS = (0.9, 0.75, 0.6, 0.45, 0.3)
NONE = np.iinfo(np.int64).min


def integer_vector(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component; null if one is null, not finite, or so large that a score could leave the long range."""
    bound = F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.size(vector), F.lit(1)))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < bound))
    return F.when(F.coalesce(fit & (F.size(vector) > 0), F.lit(False)), scaled)


class Index:
    """Posting lists of the rows ``x`` that grow as thresholds fall."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x.astype(np.float64)
        order = np.argsort(-np.abs(self.x), axis=1, kind="stable")
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(x.shape[1])[None, :], axis=1)
        ranked = np.take_along_axis(self.x, order, axis=1) ** 2
        left = np.cumsum(ranked[:, ::-1], axis=1)[:, ::-1]
        #: Norm of what is unindexed once the m largest components of a row are.
        self.rest = np.sqrt(np.column_stack([left, np.zeros(len(x))]))
        self.top = float(self.rest[:, 0].max(initial=0.0))
        self.known = np.zeros(len(x), dtype=np.int64)

    def grow(self, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """Index every row until its unindexed norm is at most ``norm``: where postings are new, and their values (a list is a column)."""
        need = np.maximum((self.rest > norm).sum(axis=1), self.known)
        fresh = (self.place >= self.known[:, None]) & (self.place < need[:, None])
        self.known = need
        return fresh, np.where(fresh, self.x, 0.0)

    def lower(self, norm: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``grow``, with the new postings list by list (dimension, rows, values)."""
        fresh, values = self.grow(norm)
        for d in np.flatnonzero(fresh.any(axis=0)):
            rows = np.flatnonzero(fresh[:, d])
            yield int(d), rows, values[rows, d]

    def unindexed(self) -> np.ndarray:
        return self.rest[np.arange(len(self.x)), self.known]


def above(x: np.ndarray, q: np.ndarray, allowed: np.ndarray, floor: np.ndarray, filled) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Scores ``(row, anchor, score)`` of the rows ``x`` at or above each anchor's last threshold, anchor by anchor as they finish.

    ``allowed[row, anchor]``: pairs that count; ``floor``: per anchor, below which no score
    matters (``NONE``: all do); ``filled(anchors, rows, scores)``: which anchors need no lower threshold.
    """
    index, qf = Index(x), q.astype(np.float64)
    norm = np.sqrt((qf**2).sum(axis=1))
    live = np.arange(len(q))
    part, used = np.zeros((len(x), len(q))), np.zeros((len(x), len(q)))
    low = np.where(floor == NONE, -np.inf, floor.astype(np.float64))
    for level in (*LEVELS, None):
        reach = 0.0 if level is None else level * index.top
        fresh, values = index.grow(reach)
        if fresh.any():
            # The new postings of all lists in one product each: a list adds its rows' values times the anchors' component.
            part += values @ qf[live].T
            used += fresh.astype(np.float64) @ (qf[live] ** 2).T
        at = np.full(len(live), -np.inf) if level is None else level * index.top * norm[live]
        at = np.maximum(at, low[live])
        # The slack covers rounding of the partial sums; scores themselves are exact.
        reachable = norm[live][None, :] ** 2 - used
        np.sqrt(np.maximum(reachable, 0.0, out=reachable), out=reachable)
        reachable *= index.unindexed()[:, None]
        reachable += part
        slack = 1e-9 * (norm[live] * index.top + 1.0)
        row, col = np.nonzero(allowed[:, live] & (reachable >= (at - slack)[None, :]))
        score = np.empty(len(row), dtype=np.int64)
        for s in range(0, len(row), 65536):
            e = s + 65536
            score[s:e] = (x[row[s:e]] * q[live[col[s:e]]]).sum(axis=1)
        kept = score >= at[col]
        row, col, score = row[kept], col[kept], score[kept]
        done = (at <= low[live]) | filled(live, col, score)
        out = done[col]
        yield row[out], live[col[out]], score[out]
        if done.all():
            return
        live, part, used = live[~done], part[:, ~done], used[:, ~done]


def best(group: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of every group: highest score first, ties by smaller identifier."""
    order = np.lexsort((ident, -score, group))
    g = group[order]
    first = np.flatnonzero(np.diff(g, prepend=-1)) if len(g) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(g)) - np.repeat(first, np.diff([*first, len(g)]))
    return order[place < k]


class Kept:
    """The best ``k`` rows seen so far of each of ``n`` windows."""

    def __init__(self, n: int, k: int) -> None:
        self.n, self.k = n, k
        self.window = self.score = self.ident = np.zeros(0, dtype=np.int64)

    def add(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Take in rows ``(window, score, ident)``; each call sorts all that is kept, so a chunk's finds come together."""
        if not found:
            return
        w, s, i = (np.concatenate(z) for z in zip((self.window, self.score, self.ident), *found, strict=True))
        top = best(w, s, i, self.k)
        self.window, self.score, self.ident = w[top], s[top], i[top]

    def worst(self) -> np.ndarray:
        """Score of the last of a full window, ``NONE`` where a window is not full."""
        full = np.bincount(self.window, minlength=self.n) >= self.k
        low = np.full(self.n, np.iinfo(np.int64).max)
        np.minimum.at(low, self.window, self.score)
        return np.where(full, low, NONE)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Identifiers, labels and vectors of a batch, a chunk of one length of vector at a time."""
    ident, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "label"))
    size = batch.column("v").value_lengths().to_numpy()
    flat, ends = batch.column("v").flatten().to_numpy(zero_copy_only=False), np.cumsum(size)
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        for s in range(0, len(at), CHUNK):
            some = at[s:s + CHUNK]
            cells = (ends[some] - dim)[:, None] + np.arange(dim)[None, :]
            yield ident[some], label[some], flat[cells]


def positives_of(batches: Iterator[pa.RecordBatch], anchors: dict, pick: int) -> Iterator[pa.RecordBatch]:
    """The best ``pick`` rows of each anchor's label among ``batches``: ``(anchor, k, score)``."""
    kept = {dim: Kept(len(a["v"]), pick) for dim, a in anchors.items()}
    for batch in batches:
        for ident, label, x in _rows(batch):
            if (a := anchors.get(x.shape[1])) is None:
                continue
            k = kept[x.shape[1]]
            # An anchor meets a chunk once, so the chunk's finds join the kept rows together.
            worst, found = k.worst(), []
            for value in np.unique(label):
                mine, rows = np.flatnonzero(a["label"] == value), np.flatnonzero(label == value)
                for s in range(0, len(mine), SIDE):
                    some = mine[s:s + SIDE]
                    other = ident[rows][:, None] != a["k"][some][None, :]

                    def full(live: np.ndarray, col: np.ndarray, score: np.ndarray) -> np.ndarray:
                        return np.bincount(col, minlength=len(live)) >= pick

                    for r, c, score in above(x[rows], a["v"][some], other, worst[some], full):
                        found.append((some[c], score, ident[rows[r]]))
            k.add(found)
    for dim, k in kept.items():
        yield pa.RecordBatch.from_arrays([pa.array(anchors[dim]["no"][k.window]), pa.array(k.ident), pa.array(k.score)],
                                         names=["anchor", "k", "score"])


def negatives_of(batches: Iterator[pa.RecordBatch], anchors: dict, pick: int) -> Iterator[pa.RecordBatch]:
    """The best ``pick`` rows in each window (``high``, ``low`` per anchor and place): ``(anchor, place, k, score)``."""
    kept = {dim: Kept(a["high"].size, pick) for dim, a in anchors.items()}
    for batch in batches:
        for ident, label, x in _rows(batch):
            if (a := anchors.get(x.shape[1])) is None:
                continue
            k, width = kept[x.shape[1]], a["high"].shape[1]
            for s in range(0, len(a["v"]), SIDE):
                some = np.arange(s, min(s + SIDE, len(a["v"])))
                high, low = a["high"][some], a["low"][some]
                # A place without a positive has low above high: nothing lies in it, and it sets no floor.
                worst, found = k.worst(), []
                floors = np.maximum(low, worst.reshape(-1, width)[some])
                floors = np.where(low <= high, floors, np.iinfo(np.int64).max).min(axis=1)
                other = label[:, None] != a["label"][some][None, :]

                def full(live: np.ndarray, col: np.ndarray, score: np.ndarray) -> np.ndarray:
                    ok = np.ones(len(live), dtype=bool)
                    for p in range(width):
                        inside = (score <= high[live[col], p]) & (score >= low[live[col], p])
                        n = np.bincount(col[inside], minlength=len(live))
                        ok &= (n >= pick) | (low[live, p] > high[live, p])
                    return ok

                for r, c, score in above(x, a["v"][some], other, floors, full):
                    for p in range(width):
                        window = some[c] * width + p
                        inside = (score <= high[c, p]) & (score >= low[c, p]) & (score >= worst[window])
                        found.append((window[inside], score[inside], ident[r[inside]]))
                k.add(found)
    for dim, k in kept.items():
        at, place = np.divmod(k.window, anchors[dim]["high"].shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(anchors[dim]["no"][at]), pa.array((place + 1).astype(np.int32)), pa.array(k.ident), pa.array(k.score)],
                                         names=["anchor", "place", "k", "score"])


def _block(table: pa.Table) -> dict[int, dict[str, np.ndarray]]:
    """Anchors of one block by length of vector."""
    if not table.num_rows:
        return {}
    size = table.column("v").combine_chunks().value_lengths().to_numpy()
    out = {}
    for dim in np.unique(size):
        part = table.take(pa.array(np.flatnonzero(size == dim))).combine_chunks()
        out[int(dim)] = {"no": part.column("anchor").to_numpy(), "k": part.column("k").to_numpy(), "label": part.column("label").to_numpy(),
                         "v": part.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)}
    return out


def _top(found: DataFrame, group: list[str], pick: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "k")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= pick)


def hard_negatives(rows: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
                   pick: int = PICK, low: int = LOW, high: int = HIGH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the rows where ``anchors`` holds.

    Vectors are arrays of whole numbers (``integer_vector``).  Rows with a null key, label or
    vector take no part.  Only vectors of one length are compared.  Rows with an anchor's own
    key are not among its positives; repeated rows otherwise count as often as they occur, and a
    repeated anchor is answered as often.  Ties go to the smaller key.  Other columns are not read.
    """
    spark = rows.sparkSession
    table = rows.select(F.col(key).cast("long").alias("k"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<long>").alias("v"),
                        F.coalesce(anchors, F.lit(False)).alias("asks"))
    table = stored(table.filter(F.col("k").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()), "rows")
    asked = stored(table.filter("asks").select("k", "label", "v", F.monotonically_increasing_id().alias("anchor")), "anchors")
    total = asked.agg(F.sum(F.size("v") + 3).alias("cells")).first()["cells"]
    root = f"{scratch_root(spark)}/negatives-{uuid.uuid4().hex}"
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    blocks = -(-(total or 0) * 8 // block_bytes)
    # Identifiers count up within every file, so their remainders deal the anchors evenly over the blocks.
    for b in range(blocks):
        block = asked.filter(F.pmod("anchor", F.lit(blocks)) == b)
        _answer(spark, table.select("k", "label", "v"), block, pick, low, high).write.parquet(f"{root}/block={b}")
    if not blocks:
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).parquet(*[f"{root}/block={b}" for b in range(blocks)])


def _answer(spark: SparkSession, table: DataFrame, block: DataFrame, pick: int, low: int, high: int) -> DataFrame:
    local = _block(block.toArrow())
    sent = spark.sparkContext.broadcast(local)
    found = table.mapInArrow(lambda it: positives_of(it, sent.value, pick), "anchor long, k long, score long")
    positives = stored(_top(found, ["anchor"], pick), "positives")
    # At most ``pick`` rows for each anchor of a block.
    got = positives.select("anchor", "rank", "score").toArrow()
    no, place, score = (got.column(c).to_numpy() for c in ("anchor", "rank", "score"))
    for a in local.values():
        order = np.argsort(a["no"])
        at = order[np.searchsorted(a["no"][order], no).clip(0, len(order) - 1)]
        mine = a["no"][at] == no
        a["high"], a["low"] = np.full((len(order), pick), NONE), np.full((len(order), pick), np.iinfo(np.int64).max)
        # low * positive <= 100 * negative <= high * positive, in whole numbers: rounded up below, down above.
        p = score[mine].astype(object)
        a["low"][at[mine], place[mine] - 1] = [-((-low * x) // 100) for x in p]
        a["high"][at[mine], place[mine] - 1] = [(high * x) // 100 for x in p]
    windows = spark.sparkContext.broadcast(local)
    found = table.mapInArrow(lambda it: negatives_of(it, windows.value, pick), "anchor long, place int, k long, score long")
    negatives = _top(found, ["anchor", "place"], pick).withColumnsRenamed({"k": "negative_id", "score": "negative_score"})
    ids = F.broadcast(block.select("anchor", F.col("k").alias("anchor_id")))
    firsts = F.broadcast(positives.select("anchor", F.col("rank").alias("place"), F.col("k").alias("positive_id"), F.col("score").alias("positive_score")))
    return (negatives.join(firsts, ["anchor", "place"]).join(ids, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


SQL = """
WITH t AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(generate_series(1, len(a.v)), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM t a JOIN t b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
w AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank
  FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 5
"""


@query("op11_hard_negatives", SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = whole(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    table = rows.select("vec_id", moved.alias("label"), integer_vector(F.col("embedding")).alias("embedding"))
    return hard_negatives(table, F.col("vec_id") % 100 == 0)
