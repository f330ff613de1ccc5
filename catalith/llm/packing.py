"""Packing of documents into sequences of bounded length, in their order.

The documents of a task form one stream of ids.  Windows of at most ``limit`` ids
are cut from it at document or sentence ends (inside a sentence only where one is
longer than a window).  Dynamic programming over these places finds the cuts with
the least cost:

    padding of the window           (none at a power of two)
  + a charge per window             (else many tiny powers of two would win)
  + a truncation penalty            (0 at a document's end, more at a sentence's, most within one)

With f the least cost up to a place and p its position, a window from i to j costs
``limit - (p_j - p_i)`` plus terms of j alone, so the best i is the least
``f_i + p_i`` among places at most ``limit`` back: a monotone queue, constant time a
step.  The few windows of a power-of-two length are tried beside it.

A stream is solved in blocks of about ``BLOCK`` ids; a block's last windows are left
open and carried into the next one.  Order is the scan order of the input, pieces
of a document follow each other, and each task ends with at most one short window.
Null text is the empty text, which still has its end id.  Repeated rows are packed
as often as they occur; columns other than key and text are not read.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm.common import stored
from catalith.llm.registry import query
from catalith.llm.segments import encoder

LIMIT = 1024
#: Costs in ids of padding.
WINDOW, AT_SENTENCE, WITHIN = 24, 4, 64
#: Ids solved at once, and windows left open at a block's end.
BLOCK, OPEN_WINDOWS = 1 << 18, 8
_END = re.compile(r"[.!?。！？](?:[\"'”’)\]]*)\s*$|\n")


def cut_windows(places: np.ndarray, penalties: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Indices into ``places`` of the cheapest cuts; 0 and the last place are always among them.

    ``places`` are ascending positions, at most ``limit`` apart, from 0.
    """
    n = len(places)
    p, pen = places.tolist(), (penalties + WINDOW).tolist()
    exact: list[list[int]] = [[] for _ in range(n)]
    size = 1
    while size < limit:
        at = np.searchsorted(places, places - size)
        hit = np.flatnonzero((at < n) & (places[np.minimum(at, n - 1)] == places - size) & (places >= size))
        for j, i in zip(hit.tolist(), at[hit].tolist()):
            exact[j].append(i)
        size *= 2
    f, back, queue = [0] * n, [0] * n, deque([(0, 0)])
    for j in range(1, n):
        pj = p[j]
        while pj - p[queue[0][1]] > limit:
            queue.popleft()
        key, i = queue[0]
        best = key + limit - pj
        for e in exact[j]:
            if f[e] < best:
                best, i = f[e], e
        f[j], back[j] = best + pen[j], i
        key = f[j] + pj
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return np.array(cuts[::-1])


@lru_cache(maxsize=4)
def sentence_ends(path: str) -> np.ndarray:
    """For every id, whether a sentence or line can end with it."""
    tok = encoder(path).tok
    return np.array([bool(_END.search(tok.decode([i]))) for i in range(tok.get_vocab_size())])


def places_of(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, and their penalties; ``ends`` marks ids that end a sentence."""
    kind = np.full(len(ids) + 1, WITHIN, dtype=np.uint8)
    kind[np.flatnonzero(ends[ids]) + 1] = AT_SENTENCE
    kind[doc_ends] = 0
    kind[0] = 0
    kind[len(ids)] = 0
    at = np.flatnonzero(kind < WITHIN)
    gaps = np.diff(at)
    if (gaps > limit).any():
        at = np.unique(np.concatenate([at, *(np.arange(at[k] + limit, at[k + 1], limit) for k in np.flatnonzero(gaps > limit))]))
    return at, kind[at].astype(np.int64)


def pack(docs: DataFrame, path: str, end_id: int = 0, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces ``(key, start, length, doc_tokens, sequence_id, offset, ids)``; ``ids`` are little-endian unsigned 32-bit.

    A sequence is the pieces of one ``sequence_id`` in the order of ``offset``.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    tail = np.array([end_id], dtype="<u4").tobytes()

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        ends = sentence_ends(path)
        first = TaskContext.get().partitionId() << 40
        made = 0
        keys: list[pa.Array] = []
        texts: list[bytes] = []
        done = 0  # ids of the first open document that are packed already
        held = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal keys, texts, done, made, held
            sizes = np.array([len(t) // 4 for t in texts], dtype=np.int64)
            doc_ends = np.cumsum(sizes) - done
            stream = b"".join(texts)[4 * done:]
            ids = np.frombuffer(stream, dtype="<u4")
            at, penalties = places_of(ids, doc_ends, ends, limit)
            cuts = at[cut_windows(at, penalties, limit)]
            if not last:
                cuts = cuts[:max(2, len(cuts) - OPEN_WINDOWS)]
            stop = cuts[-1]
            edges = np.union1d(cuts, doc_ends[doc_ends < stop])
            doc = np.searchsorted(doc_ends, edges[:-1], side="right")
            window = np.searchsorted(cuts, edges[:-1], side="right") - 1
            begins = doc_ends[doc] - sizes[doc]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(keys).take(pa.array(doc)), pa.array(edges[:-1] - begins), pa.array(np.diff(edges)), pa.array(sizes[doc]),
                 pa.array(first + made + window), pa.array(edges[:-1] - cuts[window]),
                 pa.array([stream[4 * a:4 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], type=pa.binary())],
                names=["k", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            made += len(cuts) - 1
            keep = int(np.searchsorted(doc_ends, stop, side="right"))
            done = int(stop - (doc_ends[keep] - sizes[keep])) if keep < len(texts) else 0
            keys = [pa.concat_arrays(keys).slice(keep)] if keep < len(texts) else []
            texts = texts[keep:]
            held = len(ids) - int(stop)

        for batch in batches:
            column, start = batch.column("k"), 0
            for i, t in enumerate(batch.column("t").to_pylist()):
                texts.append(enc.ids(t) + tail)
                held += len(texts[-1]) // 4
                if held >= BLOCK:
                    keys.append(column.slice(start, i + 1 - start))
                    start = i + 1
                    yield from flush(False)
            if start < len(column):
                keys.append(column.slice(start))
        if texts:
            yield from flush(True)

    out = rows.mapInArrow(solve, f"k {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    return out.withColumnRenamed("k", key)


def digest_rows(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def packed_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers as P

    return stored(digest_rows(pack(docs, P.path("byte_bpe_50k.json"))), "pack")


@query("op5_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    # Not dealt over the cores: that would scatter neighbours of a table with few splits.
    return packed_documents(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
