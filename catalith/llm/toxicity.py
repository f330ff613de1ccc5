"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon transducer turns the words of a clause into classes (insult, threat,
target, negation, reporting word) with weights; the negation, reported-speech and
target transducers, composed into one machine, mark each insult or threat with its
circumstances.  A marked word weighs its lexicon weight times the factors of its
marks; a clause weighs the sum over its words; the score of a text is the logistic
of the prior log-odds plus the weights of all its clauses.

Fitting (labels of a bounded sample, ``SAMPLE`` rows, only those allowed):

* words and word beginnings weigh the lower bound of their log-odds between toxic and
  clean texts.  Support counts distinct neighbourhoods, not texts: copies of one toxic
  text repeat its words with the same neighbours and so count once.
* a factor moves from its stated value towards the observed odds of words so marked,
  by the number of texts that show it.

Null and empty texts have no clause and score the prior.  Texts are read whole; only
the text is an input of a score.  Repeated rows score alike.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm.common import BATCH, chosen, remainder, settings, stored, whole
from catalith.llm.registry import query
from catalith.llm.transducers import Transducer, compose, reported_speech, window

#: Labelled rows that fit the grammar.
SAMPLE = 20_000
#: Least distinct neighbourhoods of a learned word; of a word beginning, and its least number of words.
WORD_SUPPORT, STEM_SUPPORT, STEM_WORDS = 4, 8, 3
#: Most clean texts with a word beginning, for each neighbourhood in toxic ones: a single insult must not
#: lend its beginning to the clean words that share it.
STEM_CLEAN = 0.02
STEMS = (3, 4, 5, 6)
#: Least log-odds of a learned entry, that many standard errors below what was seen (many words are tried).
LEAST_ODDS, ERRORS = 1.5, 2.5
THRESHOLD = 0.7

# Starting lexicons (English, German, French, Spanish).
INSULTS = """idiot idiots moron morons stupid dumb loser losers pathetic worthless trash scum disgusting clown
idiotin dummkopf versager abschaum widerlich wertlos trottel
imbécile crétin abruti ordure minable débile
imbécil estúpido estúpida basura asqueroso inútil""".split()
THREATS = """kill hurt destroy murder töten umbringen vernichten tuer détruire matar destruir""".split()
TARGETS = """you your yours he she they him her them people du dich dir ihr euch er sie tu toi vous il elle ils
tú usted ustedes él ella ellos""".split()
NEGATIONS = """not no never without nicht nie kein keine ohne ne pas jamais sans nunca sin""".split()
REPORTS = """said says say wrote writes called calls quoted reported claimed claims sagte sagt schrieb nannte
dit écrit appelé dijo dice escribió llamó""".split()
#: Factors of the marks before fitting (- negated, r reported, t aimed at a target).
FACTORS = {"": 1.0, "-": 0.5, "r": 0.6, "t": 1.2, "-r": 0.4, "-t": 0.5, "rt": 0.7, "-rt": 0.4}
#: A threat aimed at nobody weighs this much less.
AIMLESS_THREAT = 0.25
#: Texts whose evidence counts as much as a stated factor; copies a starting word counts as.
FACTOR_FAITH, SEED_FAITH = 30, 3

_WORD = re.compile(r"[^\W_]+|[\"“”„«»]")
_CLAUSE_END = re.compile(r"[.!?;:\n…]+")
_QUOTES = frozenset("\"“”„«»")


def machine() -> Transducer:
    """Negation, reported speech and target, composed."""
    return compose(compose(window("N", "-", 3), reported_speech(6)), window("Y", "t", 4))


@dataclass(frozen=True)
class Grammar:
    """What scoring needs: entries (word or beginning* -> class and weight), factors, prior log-odds."""

    words: dict[str, tuple[str, float]] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    factors: dict[str, float] = field(default_factory=lambda: dict(FACTORS))
    prior: float = -2.0


class Scorer:
    """A grammar made ready: the composed machine and a search automaton for its entries."""

    def __init__(self, grammar: Grammar) -> None:
        import ahocorasick

        self.g, self.step = grammar, machine().step
        self.plain = {w: "Y" for w in TARGETS} | {w: "N" for w in NEGATIONS} | {w: "R" for w in REPORTS} | {q: "Q" for q in _QUOTES}
        self.hits = ahocorasick.Automaton()
        for w in (*grammar.words, *grammar.stems):
            self.hits.add_word(w, len(w))
        if len(self.hits):
            self.hits.make_automaton()

    def symbol(self, word: str) -> tuple[str, float]:
        """The lexicon transducer: class and weight of a token."""
        kind, weight = self.g.words.get(word) or (self.plain.get(word, "O"), 0.0)
        if kind in "OI":
            for n in STEMS:
                if len(word) > n and (w := self.g.stems.get(word[:n], 0.0)) > weight:
                    kind, weight = "I", w
        return kind, weight

    def clauses(self, text: str | None) -> list[tuple[int, int, float, str]]:
        """``(start, end, weight, pattern)`` of the clauses that match, in order.

        ``pattern`` lists the marked words' classes and marks, as ``It`` or ``I-``.
        """
        low = (text or "").lower()
        if not low or not len(self.hits):
            return []
        found, out = [], []
        for last, size in self.hits.iter(low):
            at = last - size + 1
            if not at or not low[at - 1].isalnum():
                found.append(at)
        if not found:
            return []
        stops = [(0, 0), *(m.span() for m in _CLAUSE_END.finditer(low)), (len(low), len(low))]
        k = 0
        for (_, a), (b, _) in zip(stops, stops[1:]):
            while k < len(found) and found[k] < a:
                k += 1
            if k == len(found):
                break
            if found[k] < b:
                weight, pattern = self.weigh(_WORD.findall(low, a, b))
                if pattern:
                    out.append((a, b, weight, pattern))
        return out

    def weigh(self, tokens: list[str]) -> tuple[float, str]:
        state, total, marks_seen = 0, 0.0, []
        for token in tokens:
            kind, weight = self.symbol(token)
            state, marks = self.step[state][kind]
            if kind in "IT" and weight:
                factor = self.g.factors.get(marks, 1.0)
                if kind == "T" and "t" not in marks:
                    factor *= AIMLESS_THREAT
                total += weight * factor
                marks_seen.append(kind + marks)
        return total, " ".join(marks_seen)

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float, str]]]:
        clauses = self.clauses(text)
        z = self.g.prior + sum(c[2] for c in clauses)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z)))), clauses


@lru_cache(maxsize=2)
def _scorer(key: tuple) -> Scorer:
    words, stems, factors, prior = key
    return Scorer(Grammar({w: (k, x) for w, k, x in words}, dict(stems), dict(factors), prior))


def _key(g: Grammar) -> tuple:
    return (tuple((w, k, x) for w, (k, x) in sorted(g.words.items())), tuple(sorted(g.stems.items())), tuple(sorted(g.factors.items())), g.prior)


def toxicity(grammar: Grammar, text: Column) -> Column:
    """``struct<score, clauses>`` of a text column; a clause is ``struct<start, end, weight, pattern>``."""
    key = _key(grammar)

    @F.pandas_udf("struct<score: double, clauses: array<struct<start: int, end: int, weight: double, pattern: string>>>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _scorer(key)
        for batch in batches:
            rows = [scorer.score(t) for t in batch]
            yield pd.DataFrame({"score": [r[0] for r in rows], "clauses": [
                [dict(zip(("start", "end", "weight", "pattern"), c)) for c in r[1]] for r in rows]})

    return scored(text)


def _features(words: list[str]) -> Iterator[tuple[str, str, int]]:
    """Each word, and its beginnings as ``beginning*``, with the word and a hash of its neighbours."""
    for i, w in enumerate(words):
        near = zlib.crc32(f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}".encode())
        yield w, w, near
        for n in STEMS:
            if len(w) > n:
                yield w[:n] + "*", w, near


def _odds(s: float, n: float, toxic: int, clean: int, errors: float) -> float:
    """Log-odds of a word in s of the toxic and n of the clean texts, less so many standard errors."""
    return math.log((s + 0.5) / (n + 0.5)) - math.log((toxic + 1) / (clean + 1)) - errors * math.sqrt(1 / (s + 0.5) + 1 / (n + 0.5))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Grammar:
    """Learn a grammar from ``labelled(doc_id, text, toxic)``; rows with a null among them are not used.

    Without toxic rows the starting lexicon is used alone.
    """
    rows = labelled.dropna(subset=["doc_id", "text", "toxic"]).select("doc_id", "text", "toxic")
    rows = stored(chosen(rows, F.col("doc_id"), sample).repartition(
        max(2, rows.sparkSession.sparkContext.defaultParallelism)), "labelled")
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    seeds = {w: "I" for w in INSULTS} | {w: "T" for w in THREATS}
    prior = math.log((toxic + 1) / (clean + 1)) if toxic else -2.0
    if not toxic or not clean:
        return Grammar({w: (k, 4.0) for w, k in seeds.items()}, prior=prior)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for start in range(0, len(b), 16):  # a few texts at a time: each gives thousands of rows
                seen: set[tuple[str, str, int]] = set()
                docs: Counter = Counter()
                for t in b["text"].iloc[start:start + 16]:
                    own = set(_features([x for x in _WORD.findall(t.lower()) if x not in _QUOTES]))
                    docs.update({f for f, _, _ in own})
                    seen |= own
                yield pd.DataFrame([(f, w, near, 0) for f, w, near in seen] + [(f, "", 0, n) for f, n in docs.items()],
                                   columns=["f", "w", "near", "docs"])

    with settings(rows.sparkSession, BATCH):
        found = rows.filter("toxic = 1").select("text").mapInPandas(gather, "f string, w string, near long, docs long")
        table = (found.groupBy("f").agg(F.countDistinct(F.when(F.col("docs") == 0, F.col("near"))).alias("s"), F.sum("docs").alias("p"),
                                        F.countDistinct(F.when(F.col("docs") == 0, F.col("w"))).alias("words"))
                 .withColumn("s", F.least("s", "p"))
                 .filter(F.when(F.col("f").endswith("*"), (F.col("s") >= STEM_SUPPORT) & (F.col("words") >= STEM_WORDS))
                         .otherwise(F.col("s") >= WORD_SUPPORT)))
        # Bounded by the sample: each of its words can name six features at most.
        support = {r["f"]: r["s"] for r in table.select("f", "s").collect()}

    known = support | {w: support.get(w, 0) for w in seeds}
    names = frozenset(known)

    def against(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n: Counter = Counter()
            for t in b["text"]:
                words = set(_WORD.findall(t.lower()))
                n.update(names & ({w[:k] + "*" for w in words for k in STEMS if len(w) > k} | words))
            yield pd.DataFrame(list(n.items()), columns=["f", "n"]).astype({"n": "int64"})

    with settings(rows.sparkSession, BATCH):
        other = {r["f"]: r["n"] for r in rows.filter("toxic = 0").select("text").mapInPandas(against, "f string, n long")
                 .groupBy("f").agg(F.sum("n").alias("n")).collect()}
    words: dict[str, tuple[str, float]] = {}
    stems: dict[str, float] = {}
    for f, s in known.items():
        seed = f in seeds
        s += SEED_FAITH * seed
        if _odds(s, other.get(f, 0), toxic, clean, 1.0 if seed else ERRORS) < LEAST_ODDS:
            continue
        if f.endswith("*") and other.get(f, 0) > STEM_CLEAN * s:
            continue
        weight = _odds(s, other.get(f, 0), toxic, clean, 1.0)
        if f.endswith("*"):
            stems[f[:-1]] = weight
        else:
            words[f] = (seeds.get(f, "I"), weight)
    return _with_factors(rows, Grammar(words, stems, dict(FACTORS), prior))


def _with_factors(rows: DataFrame, grammar: Grammar) -> Grammar:
    """Move the factors of marks towards what texts with a single marked word show."""
    scored = rows.select("toxic", toxicity(grammar, F.col("text"))["clauses"].alias("c"))
    shown = scored.filter((F.size("c") == 1) & ~F.col("c")[0]["pattern"].contains(" ")).select(
        "toxic", F.substring(F.col("c")[0]["pattern"], 2, 9).alias("marks"))
    with settings(rows.sparkSession, BATCH):
        seen = {(r["marks"], r["toxic"]): r["n"] for r in shown.groupBy("marks", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    odds = lambda m: math.log((seen.get((m, 1), 0) + 1) / (seen.get((m, 0), 0) + 1)) - grammar.prior
    plain = max(odds(""), 1.0)
    factors = {}
    for marks, stated in FACTORS.items():
        n = seen.get((marks, 1), 0) + seen.get((marks, 0), 0)
        observed = max(0.0, min(1.5, odds(marks) / plain))
        factors[marks] = stated if not marks else (n * observed + FACTOR_FAITH * stated) / (n + FACTOR_FAITH)
    return Grammar(grammar.words, grammar.stems, factors, grammar.prior)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with their ``toxic`` label, of the documents that may be learned from."""
    known = labels.filter(F.coalesce(remainder(F.col("doc_id"), 3) != 1, F.lit(False))).filter(F.col("toxic").isin(0, 1))
    picked = chosen(known.select("doc_id", F.col("toxic").cast("int").alias("toxic")), F.col("doc_id"), SAMPLE)
    # About SAMPLE rows of two numbers: bounded by the parameter.
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


@query("op1_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = whole(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text")
    grammar = fit(labelled_rows(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    t = docs.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), toxicity(grammar, F.col("text")).alias("t"))
    return stored(t.select("doc_id", "held_out", F.col("t.score").alias("score"), (F.col("t.score") >= THRESHOLD).cast("int").alias("predicted"),
                           F.size("t.clauses").alias("n_clauses")), "toxicity")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    grammar = fit(labelled_rows(docs, labels))
    return stored(docs.filter(toxicity(grammar, F.col("text"))["score"] < THRESHOLD).select(*docs.columns), "clean")
