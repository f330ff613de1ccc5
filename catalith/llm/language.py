"""Language identification by one Bloom filter over n-grams whose slots hold language bitmasks.

The filter is bit-sliced: a slot is an integer with a bit per language, and the slots
of an n-gram's hashes ANDed together give all languages that contain it at once.  A
text's n-grams are looked up together; per language the bits are counted and corrected
for the false positives its slice is known to give (its fill to the power of the number
of hashes).  The language with the largest corrected count is predicted.

A language contains an n-gram if a share of its training texts do, and if that share is
not far below that of the language that has it most.  N-grams are of 1 to 4 characters of
words in lower case, with a blank at either end.  Training reads whole texts of a bounded
sample (``SAMPLE`` rows).

``und``: the text is null or has no letter, or no language was learned.  A text whose n-grams are all
unknown gets the most frequent language, score 0.  Ties go to the first in the order
of frequency, then name.  At most 64 languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm.common import BATCH, chosen, remainder, settings, stored, whole
from catalith.llm.registry import query

SAMPLE = 20_000
SLOTS, HASHES = 1 << 20, 3
SIZES = (1, 2, 3, 4)
#: Least share of a language's texts, and least share of the largest language's share.
SHARE, OF_LARGEST = 0.004, 0.25
#: Characters looked up at once.
AT_ONCE = 1 << 15
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str | None) -> str:
    """Lower-case letters, words parted by one blank, a blank at either end; a single blank if there is no letter."""
    return " " + _NOT_LETTERS.sub(" ", (text or "").lower()).strip() + " " if text else " "


def grams(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of all n-grams of a run of code points (``uint32``), with 0 in place of those over a 0."""
    out = []
    x = codes.astype(np.uint64)
    h = np.zeros(len(x), dtype=np.uint64)
    ok = np.ones(len(x), dtype=bool)
    for n in range(1, max(SIZES) + 1):
        m = len(x) - n + 1
        if m <= 0:
            break
        h = (h[:m] + x[n - 1:n - 1 + m] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        ok = ok[:m] & (x[n - 1:n - 1 + m] != 0)
        if n in SIZES:
            out.append(np.concatenate([np.where(ok, h | np.uint64(1), 0), np.zeros(n - 1, dtype=np.uint64)]))
    return np.stack(out) if out else np.zeros((0, len(x)), dtype=np.uint64)


def slots(h: np.ndarray, size: int = SLOTS) -> list[np.ndarray]:
    """The slots of hashed n-grams, one array per hash function."""
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [((a + np.uint64(k) * b) % np.uint64(size)).astype(np.int64) for k in range(HASHES)]


@dataclass(frozen=True)
class Filter:
    """Languages in order of frequency, slots of language bits, and each language's false-positive rate."""

    languages: tuple[str, ...]
    table: np.ndarray
    wrong: np.ndarray

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts ``(texts, languages)`` and numbers of n-grams."""
        total = np.zeros((len(texts), len(self.languages)))
        number = np.zeros(len(texts))
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (not size or size + len(texts[stop]) < AT_ONCE):
                size += len(texts[stop]) + 1
                stop += 1
            part = texts[start:stop]
            codes = np.frombuffer("\0".join([*part, ""]).encode("utf-32-le"), dtype=np.uint32)
            begins = np.cumsum([0, *(len(t) + 1 for t in part[:-1])])
            for h in grams(codes):
                at = slots(h, len(self.table))
                mask = self.table[at[0]]
                for s in at[1:]:
                    mask = mask & self.table[s]
                there = h != 0
                mask = np.where(there, mask, np.uint64(0))
                number[start:stop] += np.add.reduceat(there.astype(np.int64), begins)
                for k in range(len(self.languages)):
                    total[start:stop, k] += np.add.reduceat(((mask >> np.uint64(k)) & np.uint64(1)).astype(np.int64), begins)
            start = stop
        return np.maximum(0, (total - self.wrong * number[:, None]) / (1 - self.wrong)), number

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        plain = [normal(t) for t in texts]
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        found, _ = self.counts(plain)
        best = found.argmax(axis=1)
        score = found.max(axis=1) / np.maximum(found.sum(axis=1), 1e-9)
        letters = np.array([bool(t.strip()) for t in plain], dtype=bool)
        return [self.languages[b] if ok else "und" for b, ok in zip(best, letters)], np.where(letters, score, 0.0)


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Filter:
    """Learn from ``labelled(doc_id, text, lang)``; rows with a null are not used."""
    rows = labelled.dropna(subset=["doc_id", "text", "lang"]).select("doc_id", "text", "lang")
    rows = chosen(rows, F.col("doc_id"), sample)

    def per_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, part in b.groupby("lang"):
                each = [np.unique(grams(np.frombuffer(normal(t).encode("utf-32-le"), dtype=np.uint32))) for t in part["text"]]
                h, n = np.unique(np.concatenate(each), return_counts=True)
                h, n = h[h != 0], n[h != 0]
                yield pd.DataFrame({"lang": lang, "h": h.view(np.int64), "n": n, "texts": 0})
                yield pd.DataFrame({"lang": [lang], "h": [0], "n": [0], "texts": [len(part)]})

    with settings(rows.sparkSession, BATCH):
        counted = stored(rows.select("text", "lang").mapInPandas(per_text, "lang string, h long, n long, texts long")
                         .groupBy("lang", "h").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")), "grams")
    size = {r["lang"]: r["texts"] for r in counted.filter("h = 0").select("lang", "texts").collect()}
    languages = tuple(sorted(size, key=lambda x: (-size[x], x)))
    if len(languages) > 64:
        raise ValueError(f"{len(languages)} languages; a bitmask holds 64")
    if not languages:
        return Filter((), np.zeros(1, dtype=np.uint64), np.zeros(0))
    totals = rows.sparkSession.createDataFrame(list(size.items()), "lang string, total long")
    share = counted.filter("h <> 0").join(F.broadcast(totals), "lang").select("lang", "h", "n", (F.col("n") / F.col("total")).alias("share"))
    largest = share.groupBy("h").agg(F.max("share").alias("top"))
    # At most 1 / SHARE times the n-grams of one text, per language.
    kept = share.filter((F.col("share") >= SHARE) & (F.col("n") >= 2)).join(largest, "h").filter(F.col("share") >= OF_LARGEST * F.col("top")).select("lang", "h").toPandas()
    table = np.zeros(SLOTS, dtype=np.uint64)
    wrong = np.zeros(len(languages))
    for k, lang in enumerate(languages):
        for s in slots(kept.loc[kept["lang"] == lang, "h"].to_numpy(dtype=np.int64).view(np.uint64)):
            np.bitwise_or.at(table, s, np.uint64(1 << k))
        wrong[k] = np.mean((table >> np.uint64(k)) & np.uint64(1)) ** HASHES
    return Filter(languages, table, wrong)


def language(model: Filter, text: Column) -> Column:
    """``struct<lang, score>`` of a text column; ``score`` is the language's share of all corrected counts."""
    shared = {"languages": model.languages, "at": np.flatnonzero(model.table), "wrong": model.wrong, "slots": len(model.table)}
    shared["mask"] = model.table[shared["at"]]

    @F.pandas_udf("struct<lang: string, score: double>")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = np.zeros(shared["slots"], dtype=np.uint64)
        table[shared["at"]] = shared["mask"]
        own = Filter(shared["languages"], table, shared["wrong"])
        for batch in batches:
            lang, score = own.predict(batch.tolist())
            yield pd.DataFrame({"lang": lang, "score": score})

    return told(text)


def learnable(docs: DataFrame) -> DataFrame:
    return docs.filter(F.coalesce(remainder(F.col("doc_id"), 4) != 2, F.lit(False))).select("doc_id", "text", "lang")


@query("op7_language")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = whole(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text", "lang")
    model = fit(learnable(docs))
    rows = docs.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), language(model, F.col("text")).alias("l"))
    return stored(rows.select("doc_id", "held_out", F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score")), "language")


def drop_unknown(docs: DataFrame) -> DataFrame:
    """``docs`` without texts that have no letter or no n-gram of any learned language."""
    told = language(fit(learnable(docs)), F.col("text"))
    kept = docs.withColumn("_catalith_l", told).filter("_catalith_l.lang <> 'und' and _catalith_l.score > 0")
    return stored(kept.select(*docs.columns), "known")
