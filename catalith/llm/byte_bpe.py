"""Byte-level BPE by a local rank file: encode whole texts, decode to raw bytes.

Each match of the split pattern is merged separately.  A long text is cut, before
the pattern runs, at single spaces between two other characters: no match crosses
such a place, so the cuts change no id and bound what one call has to hold.

Null text is the empty text (no ids).  Null ids decode to null.  Rows, ties and
repeats are kept one to one; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm.common import stored, whole
from catalith.llm.registry import query

#: Characters given to the library at once, about.
CHUNK = 1 << 16
_SAFE = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The library's encoding of a rank file, one per Python worker."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Cut ``text`` before a single space between other characters, ``size`` characters apart or more."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``: the ids of the whole text, without special tokens."""
    @F.pandas_udf("array<int>")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path, pattern)
        for batch in batches:
            yield pd.Series([[i for part in safe_chunks(t or "") for i in enc.encode_ordinary(part)] for t in batch], dtype=object)

    return docs.withColumn(out, ids_of(F.col(text)))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """Add ``out``: the raw bytes the ids stand for, which need not be valid UTF-8 when ids were cut."""
    @F.pandas_udf("binary")
    def bytes_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path, pattern)
        for batch in batches:
            yield pd.Series([None if x is None else enc.decode_bytes(x.tolist()) for x in batch], dtype=object)

    return docs.withColumn(out, bytes_of(F.col(ids)))


@query("op2_byte_bpe")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    docs = whole(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text")
    both = decode(encode(docs, path, P.PATTERN).drop("text"), path, P.PATTERN)
    return stored(both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256")), "bpe")
