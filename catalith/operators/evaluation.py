"""Ranking, classification and agreement metrics for retrieval runs.

Only the metric names are published; the definitions are the usual ones and are
stated in each docstring.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalith.functions.text import clean_text


def query_metrics(results: DataFrame, judgements: DataFrame, depth: int = 10) -> DataFrame:
    """Per query: recall@5/10, precision@5, nDCG@10 and reciprocal rank.

    ``results(query_id, id, rank)``; ``judgements(query_id, id, grade)`` with
    grade > 0 relevant; a query without relevant items has null recall and nDCG.
    Gain is the grade, discounted by log2(rank + 1).  A query with a third of
    all judgements is counted by partial sums, and the ideal ranking keeps only
    ``depth`` rows per task.
    """
    j = judgements.select("query_id", "id", "grade")
    hits = results.select("query_id", "id", "rank").join(j, ["query_id", "id"], "left").withColumn(
        "grade", F.coalesce("grade", F.lit(0)))
    rel = F.col("grade") > 0
    gain = F.col("grade") / F.log2(F.col("rank") + 1)
    got = hits.groupBy("query_id").agg(
        F.count_if(rel & (F.col("rank") <= 5)).alias("_h5"), F.count_if(rel & (F.col("rank") <= 10)).alias("_h10"),
        F.sum(F.when(F.col("rank") <= depth, gain)).alias("_dcg"), F.min(F.when(rel, F.col("rank"))).alias("_first"))
    total = j.groupBy("query_id").agg(F.count_if(F.col("grade") > 0).alias("relevant"))
    w = Window.partitionBy("query_id").orderBy(F.desc("grade"), "id")
    ideal = j.filter("grade > 0").withColumn("_p", F.row_number().over(w)).filter(F.col("_p") <= depth)
    ideal = ideal.groupBy("query_id").agg(F.sum(F.col("grade") / F.log2(F.col("_p") + 1)).alias("_idcg"))
    out = total.join(got, "query_id", "left").join(ideal, "query_id", "left")
    zero = F.lit(0)
    return out.select(
        "query_id", "relevant",
        F.try_divide(F.coalesce("_h5", zero).cast("double"), "relevant").alias("recall_at_5"),
        F.try_divide(F.coalesce("_h10", zero).cast("double"), "relevant").alias("recall_at_10"),
        (F.coalesce("_h5", zero) / F.lit(5.0)).alias("precision_at_5"),
        F.try_divide(F.coalesce("_dcg", F.lit(0.0)), F.col("_idcg")).alias("ndcg_at_10"),
        F.coalesce(F.try_divide(F.lit(1.0), F.col("_first")), F.lit(0.0)).alias("reciprocal_rank"))


def mean_metrics(per_query: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Means over queries, per slice when ``by`` is given."""
    cols = ["recall_at_5", "recall_at_10", "precision_at_5", "ndcg_at_10", "reciprocal_rank"]
    aggs = [F.count(F.lit(1)).alias("queries"), *[F.avg(c).alias("mrr" if c == "reciprocal_rank" else c) for c in cols]]
    return per_query.groupBy(*by).agg(*aggs) if by else per_query.agg(*aggs)


def filter_and_abstention(runs: DataFrame) -> DataFrame:
    """required_filter_error_rate and no_answer_abstention_rate.

    ``runs(query_id, answerable, returned, conflicts)``: share of returned rows
    that conflict with a required filter, and share of unanswerable queries for
    which nothing was returned.
    """
    return runs.agg(
        F.try_divide(F.sum("conflicts").cast("double"), F.sum("returned")).alias("required_filter_error_rate"),
        F.try_divide(F.count_if(~F.col("answerable") & (F.col("returned") == 0)).cast("double"),
                     F.count_if(~F.col("answerable"))).alias("no_answer_abstention_rate"))


def class_counts(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """tp, fp, fn per label of multi-label assignments (id, label)."""
    p = predicted.select("id", "label").distinct().withColumn("_p", F.lit(1))
    t = truth.select("id", "label").distinct().withColumn("_t", F.lit(1))
    j = p.join(t, ["id", "label"], "full_outer")
    has_p, has_t = F.col("_p").isNotNull(), F.col("_t").isNotNull()
    return j.groupBy("label").agg(F.count_if(has_p & has_t).alias("tp"), F.count_if(has_p & ~has_t).alias("fp"),
                                  F.count_if(~has_p & has_t).alias("fn"))


def _f1(tp: str, fp: str, fn: str):
    return F.try_divide(2.0 * F.col(tp), 2.0 * F.col(tp) + F.col(fp) + F.col(fn))


def f1_scores(counts: DataFrame) -> DataFrame:
    """Micro F1 over all decisions and macro F1 as the mean over labels."""
    per = counts.withColumn("_f1", F.coalesce(_f1("tp", "fp", "fn"), F.lit(0.0)))
    s = per.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.avg("_f1").alias("macro_f1"))
    return s.select("tp", "fp", "fn", _f1("tp", "fp", "fn").alias("micro_f1"), "macro_f1")


def family_split(df: DataFrame, text: str, shares: tuple[int, int] = (80, 10)) -> DataFrame:
    """Add ``family`` (hash of the cleaned content) and ``split``.

    Every copy of a content gets the same family, and the split depends on the
    family alone, so copies never straddle train, dev and test.  Nothing is
    grouped: a family with a third of all rows is assigned row by row.
    """
    family = F.sha2(F.lower(clean_text(text)), 256)
    bucket = F.pmod(F.conv(F.substring(family, 1, 8), 16, 10).cast("long"), F.lit(100))
    return df.withColumn("family", family).withColumn(
        "split", F.when(bucket < shares[0], F.lit("train")).when(bucket < sum(shares), F.lit("dev")).otherwise(F.lit("test")))


def judge_agreement(judgements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summary, disagreements) over items graded by at least two judges."""
    per = judgements.groupBy("query_id", "id").agg(
        F.count_distinct("judge").alias("judges"), F.min("grade").alias("lowest"), F.max("grade").alias("highest"))
    two = per.filter("judges >= 2")
    same = F.col("lowest") == F.col("highest")
    summary = two.agg(F.count(F.lit(1)).alias("items"), F.count_if(same).alias("agreed"),
                      F.avg(same.cast("double")).alias("agreement"))
    return summary, two.filter(~same)


def retrieval_log(results: DataFrame, policy_version: str, path: str | None = None) -> DataFrame:
    """Log rows without the query text: its hash, filters, scores and returned ids.

    ``results(query_id, query_text, id, rank, score, filter_state)``; appended to
    ``path`` partitioned by day when given.
    """
    log = results.select(
        F.sha2("query_text", 256).alias("query_hash"), "id", "rank", "score", "filter_state",
        F.lit(policy_version).alias("policy_version"), F.current_timestamp().alias("logged_at"))
    if path:
        log.withColumn("day", F.to_date("logged_at")).write.mode("append").partitionBy("day").parquet(path)
    return log
