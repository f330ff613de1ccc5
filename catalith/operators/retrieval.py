"""Ranking datasets by field vectors, exact filters and concept links.

The rules are published only as a specification, so each definition is stated
here.  A retrieval result is a candidate; it never becomes a relation by itself.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.functions.text import uid
from catalith.layout import dictionary_join

# Python workers receive these helpers by value (no installed copy needed).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERY_BLOCK = 2_048
CORPUS_BLOCK = 16_384


def changed_inputs(metadata: DataFrame, artefacts: DataFrame, key: Sequence[str], input_hash: str) -> DataFrame:
    """Rows whose input hash differs from, or is missing in, the stored artefacts."""
    old = artefacts.select(*key, F.col(input_hash).alias("_old"))
    return metadata.join(old, list(key), "left").filter(~F.col(input_hash).eqNullSafe(F.col("_old"))).drop("_old")


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two arrays; unknown when a length differs or a norm is zero."""
    x = F.col(a) if isinstance(a, str) else a
    y = F.col(b) if isinstance(b, str) else b
    dot = F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    def norm(v: Column) -> Column:
        return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double")))

    return F.when(F.size(x) == F.size(y), F.try_divide(dot, norm(x) * norm(y)))


def _unit(vectors: pd.Series) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.full_like(m, np.nan), where=n > 0)


def _above(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, least: float) -> pd.DataFrame:
    """Every pair of one block that scores at least ``least``."""
    score = np.nan_to_num(q @ rows.T, nan=-np.inf)
    a, b = np.nonzero(score >= least)
    return pd.DataFrame({"query_id": q_ids[a], "id": ids[b], "score": score[a, b]})


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows per query of one block, ties by id."""
    score = q @ rows.T
    order = np.argsort(ids, kind="stable")
    score, ids = score[:, order], ids[order]
    top = np.argsort(-np.where(np.isnan(score), -np.inf, np.round(score, 12)), axis=1, kind="stable")[:, :k]
    out = pd.DataFrame({"query_id": np.repeat(q_ids, top.shape[1]), "id": ids[top].ravel(),
                        "score": np.take_along_axis(score, top, axis=1).ravel()})
    return out[~out["score"].isna()]


def knn(queries: DataFrame, corpus: DataFrame, k: int, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Exact k nearest corpus rows of each query by cosine: query_id, id, score, rank.

    ``queries(query_id, model, vec)``, ``corpus(id, model, vec)``; vectors of
    different model versions never meet.  Each Arrow batch multiplies its rows
    with the query matrix and keeps k per query, so the pairs are never written
    out.  Up to ``query_block`` queries travel as one broadcast; more are split
    into blocks that meet blocks of the corpus on the executors.
    """
    near = _scan(queries, corpus, query_block, lambda *block: _best(*block, k))
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "id")
    return near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def concept_scores(datasets: DataFrame, concepts: DataFrame, min_score: float, concept_block: int = QUERY_BLOCK) -> DataFrame:
    """(dataset_id, concept_id, score) of every pair that reaches ``min_score``.

    ``datasets(dataset_id, model, vec)``, ``concepts(concept_id, model, vec)``.
    Pairs below the threshold are never written out.
    """
    q = concepts.select(F.col("concept_id").alias("query_id"), "model", "vec")
    c = datasets.select(F.col("dataset_id").alias("id"), "model", "vec")
    near = _scan(q, c, concept_block, lambda *block: _above(*block, min_score))
    return near.select(F.col("id").alias("dataset_id"), F.col("query_id").alias("concept_id"), "score")


def _scan(queries: DataFrame, corpus: DataFrame, query_block: int, keep) -> DataFrame:
    """Run ``keep(query ids, query matrix, ids, matrix)`` over every pair of blocks; an unknown model meets none."""
    queries, corpus = queries.filter(F.col("model").isNotNull()), corpus.filter(F.col("model").isNotNull())
    id_type = corpus.schema["id"].dataType.simpleString()
    q_type = queries.schema["query_id"].dataType.simpleString()
    schema = f"query_id {q_type}, id {id_type}, score double"
    head = queries.select("query_id", "model", "vec").limit(query_block + 1).toPandas()
    if len(head) <= query_block:
        groups = {m: (g["query_id"].to_numpy(), _unit(g["vec"])) for m, g in head.groupby("model")}
        shared = queries.sparkSession.sparkContext.broadcast(groups)

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for model, rows in pdf.groupby("model"):
                    if model in shared.value:
                        q_ids, q = shared.value[model]
                        yield keep(q_ids, q, rows["id"].to_numpy(), _unit(rows["vec"]))

        return corpus.select("id", "model", "vec").mapInPandas(scan, schema)
    return _blocked(queries, corpus, query_block, schema, keep)


def _blocked(queries: DataFrame, corpus: DataFrame, query_block: int, schema: str, keep) -> DataFrame:
    # Blocks of bounded size on both sides; every query block meets every corpus
    # block of its model once, in its own task.
    n_q = max(1, -(-queries.count() // query_block))
    n_c = max(1, -(-corpus.count() // CORPUS_BLOCK))
    q = queries.select("query_id", "model", "vec", F.pmod(F.xxhash64("query_id"), F.lit(n_q)).alias("qb"))
    q = q.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))).withColumn("cb", F.col("cb").cast("long"))
    c = corpus.select("id", "model", "vec", F.pmod(F.xxhash64("id"), F.lit(n_c)).alias("cb"))
    c = c.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))).withColumn("qb", F.col("qb").cast("long"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        return keep(left["query_id"].to_numpy(), _unit(left["vec"]), right["id"].to_numpy(), _unit(right["vec"]))

    keys = ["model", "qb", "cb"]
    return q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(meet, schema)


def fuse_scores(weights: Mapping[str, float], components: Mapping[str, Column]) -> Column:
    """Weighted mean over the available components; unknown when none is."""
    total, weight = F.lit(0.0), F.lit(0.0)
    for name, c in components.items():
        w = F.lit(float(weights[name]))
        total = total + F.coalesce(w * c, F.lit(0.0))
        weight = weight + F.when(c.isNotNull(), w).otherwise(F.lit(0.0))
    return F.try_divide(total, weight)


def filter_value(value: Column, wanted: Column) -> Column:
    """``not_required`` / ``unknown`` / ``match`` / ``conflict`` for one exact filter."""
    return (F.when(wanted.isNull(), F.lit("not_required")).when(value.isNull(), F.lit("unknown"))
            .when(value == wanted, F.lit("match")).otherwise(F.lit("conflict")))


def filter_period(start: Column, end: Column, want_start: Column, want_end: Column) -> Column:
    """Interval overlap; unknown while either end of the dataset's period is."""
    none = want_start.isNull() & want_end.isNull()
    apart = (F.coalesce(start > want_end, F.lit(False)) | F.coalesce(end < want_start, F.lit(False)))
    return (F.when(none, F.lit("not_required")).when(apart, F.lit("conflict"))
            .when(start.isNull() | end.isNull(), F.lit("unknown")).otherwise(F.lit("match")))


def exact_filter(df: DataFrame, decisions: Mapping[str, Column]) -> DataFrame:
    """Add a decision per filter and ``filter_state``; conflicts are removed.

    One conflict excludes the row whatever its score; an unknown value does not
    match but stays visible.
    """
    out = df
    for name, c in decisions.items():
        out = out.withColumn(f"filter_{name}", c)
    cols = [F.col(f"filter_{n}") for n in decisions]
    conflict, unknown = F.lit(False), F.lit(False)
    for c in cols:
        conflict = conflict | (c == "conflict")
        unknown = unknown | (c == "unknown")
    state = F.when(conflict, F.lit("conflict")).when(unknown, F.lit("unknown")).otherwise(F.lit("match"))
    return out.withColumn("filter_state", state).filter("filter_state <> 'conflict'")


def concept_candidates(scores: DataFrame, min_score: float, max_concepts: int, ancestors: DataFrame | None = None
                       ) -> DataFrame:
    """Dataset -> concept candidates with rank and margin to the best one.

    ``scores(dataset_id, concept_id, score)``, ``ancestors(concept_id, ancestor)``
    without the concept itself.  Below ``min_score`` the dataset abstains.  Of two
    related candidates of a dataset the better one stays (ties by concept id).
    The rank counts the remaining candidates, so the limit drops nothing that an
    earlier step should have removed.
    """
    ok = scores.filter(F.col("score") >= min_score)
    if ancestors is not None:
        place = F.struct(F.col("score"), F.col("concept_id"))
        up = dictionary_join(ok, ancestors, ["concept_id"])
        below = up.groupBy("dataset_id", F.col("ancestor").alias("concept_id")).agg(F.max(place).alias("_below"))
        own = ok.select("dataset_id", F.col("concept_id").alias("ancestor"), place.alias("_above"))
        above = up.join(own, ["dataset_id", "ancestor"]).groupBy("dataset_id", "concept_id").agg(
            F.max("_above").alias("_above"))
        j = ok.join(below, ["dataset_id", "concept_id"], "left").join(above, ["dataset_id", "concept_id"], "left")
        beaten = F.coalesce(F.col("_below") > place, F.lit(False)) | F.coalesce(F.col("_above") > place, F.lit(False))
        ok = j.filter(~beaten).drop("_below", "_above")
    best = ok.groupBy("dataset_id").agg(F.max("score").alias("_best"))
    w = Window.partitionBy("dataset_id").orderBy(F.desc("score"), "concept_id")
    top = ok.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= max_concepts)
    return top.join(best, "dataset_id").select(
        "dataset_id", "concept_id", "score", "rank", (F.col("_best") - F.col("score")).alias("margin"),
        F.lit("semantic_candidate").alias("link_status"))


def merge_channels(**channels: DataFrame) -> DataFrame:
    """Union of (query_id, id, score) channels: best score and the channel list."""
    parts = [d.select("query_id", "id", "score", F.lit(n).alias("channel")) for n, d in channels.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionAll(p)
    # At most one entry per channel name, so the set is bounded.
    return rows.groupBy("query_id", "id").agg(
        F.max("score").alias("score"), F.array_sort(F.collect_set("channel")).alias("channels"))


def concept_channel(query_concepts: DataFrame, dataset_concepts: DataFrame) -> DataFrame:
    """query -> concept -> dataset: the weaker of the two link scores, best concept wins."""
    q = query_concepts.select("query_id", "concept_id", F.col("score").alias("_q"))
    d = dataset_concepts.select(F.col("dataset_id").alias("id"), "concept_id", F.col("score").alias("_d"))
    return dictionary_join(d, q, ["concept_id"]).groupBy("query_id", "id").agg(
        F.max(F.least("_q", "_d")).alias("score"))


def retrieve(ranked: DataFrame, metadata: DataFrame, decisions: Mapping[str, Column], k: int) -> DataFrame:
    """Result rows: title, provider, filters, link, evidence and a stable result id.

    ``ranked(query_id, id, score, channels)``.  Filters run before ranking, so a
    conflicting dataset never takes a place.
    """
    joined = exact_filter(ranked.join(metadata, "id"), decisions)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    top = joined.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.withColumn("retrieval_result_id", uid("result", "query_id", "id")).withColumn(
        "concept_link_status", F.lit("semantic_candidate"))


def title_tokens(c: Column | str) -> Column:
    """Distinct lower-case word tokens of a title."""
    col = F.col(c) if isinstance(c, str) else c
    words = F.split(F.lower(col), "[^\\p{L}\\p{N}]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def lexical_baseline(queries: DataFrame, titles: DataFrame, k: int) -> DataFrame:
    """Titles by number of shared query words: query_id, id, overlap, rank.

    ``queries(query_id, text)``, ``titles(id, title)``; the query words are the
    dictionary side of the join.
    """
    q = queries.select("query_id", F.explode(title_tokens("text")).alias("token"))
    t = titles.select("id", F.explode(title_tokens("title")).alias("token"))
    hits = dictionary_join(t, q, ["token"]).groupBy("query_id", "id").agg(F.count(F.lit(1)).alias("overlap"))
    w = Window.partitionBy("query_id").orderBy(F.desc("overlap"), "id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
