"""Tokens of fields or sections, by character offsets of one encoding of the whole text.

A document is encoded once.  The token spans are joined to the section spans as
intervals.  A token that lies over a boundary goes whole to the section that holds
most of its characters, on a tie to the earlier one; a token outside all sections
goes to section -1.  So the counts of a document add up to the tokens of its text.

Default sections are the lines of the text, each with its line end.  Null text is
empty: one section 0 from 0 to 0 without tokens.  Repeated rows give repeated
results; columns other than key, text and spans are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm.common import stored, whole
from catalith.llm.registry import query
from catalith.llm.segments import encoder


def line_spans(text: str) -> np.ndarray:
    """Starts and ends of the lines; a text of no characters is one empty line."""
    lengths = [len(x) + 1 for x in text.split("\n")]
    lengths[-1] -= 1
    if len(lengths) > 1 and lengths[-1] == 0:
        lengths.pop()
    ends = np.cumsum(lengths)
    return np.stack([ends - lengths, ends], axis=1)


def attribute(tokens: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether the token lies over more than one section or beyond its own.

    ``tokens`` and ``spans`` are (n, 2) arrays of starts and ends; sections are
    sorted and don't overlap.
    """
    if not len(tokens) or not len(spans):
        return np.full(len(tokens), -1), np.zeros(len(tokens), dtype=bool)
    starts, ends = tokens[:, 0], np.maximum(tokens[:, 1], tokens[:, 0] + 1)
    first = np.searchsorted(spans[:, 1], starts, side="right")
    last = np.searchsorted(spans[:, 0], ends, side="left") - 1
    best, most = np.full(len(tokens), -1), np.zeros(len(tokens), dtype=np.int64)
    at = first.copy()
    for _ in range(int(np.max(last - first, initial=0)) + 1):
        ok = at <= last
        k = np.minimum(at, len(spans) - 1)
        shared = np.where(ok, np.minimum(ends, spans[k, 1]) - np.maximum(starts, spans[k, 0]), 0)
        better = shared > most
        best[better], most[better] = k[better], shared[better]
        at += 1
    return best, (best >= 0) & (most < ends - starts)


def section_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", spans: str | None = None) -> DataFrame:
    """``(key, section, start, end, n_tokens, n_crossing)`` for every section of every document.

    ``spans`` names a column array<struct<start,end>> of sorted sections that don't overlap.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"), *([F.col(spans).alias("s")] if spans else []))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = batch.column("t").to_pylist()
            given = batch.column("s").to_pylist() if spans else [None] * len(texts)
            parts: list[np.ndarray] = []
            for i, (t, s) in enumerate(zip(texts, given)):
                where = np.array([(x["start"], x["end"]) for x in s or ()], dtype=np.int64).reshape(-1, 2) if spans else line_spans(t)
                best, crossing = attribute(enc.spans(t), where)
                n = np.bincount(best + 1, minlength=len(where) + 1)
                x = np.bincount(best[crossing] + 1, minlength=len(where) + 1)
                block = np.column_stack([np.full(len(n), i), np.arange(-1, len(where)), np.vstack([[-1, -1], where]), n, x])
                parts.append(block if n[0] else block[1:])
            rows = np.concatenate(parts) if parts else np.zeros((0, 6), dtype=np.int64)
            outside = rows[:, 1] < 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("k").take(pa.array(rows[:, 0])), pa.array(rows[:, 1]), pa.array(rows[:, 2], mask=outside),
                 pa.array(rows[:, 3], mask=outside), pa.array(rows[:, 4]), pa.array(rows[:, 5])],
                names=["k", "section", "start", "end", "n_tokens", "n_crossing"])

    made = rows.mapInArrow(count, f"k {kind}, section long, start long, end long, n_tokens long, n_crossing long")
    return made.withColumnRenamed("k", key)


@query("op6_token_counts")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document."""
    import public_tokenizers as P

    docs = whole(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text")
    return stored(section_tokens(docs, P.path("byte_bpe_50k.json")), "counts")
