import numpy as np
from pyspark.sql import functions as F

from catalith.operators import evaluation as ev
from catalith.operators import retrieval as rt


def vectors(spark, n, key, seed, model="m"):
    rng = np.random.default_rng(seed)
    rows = [(i, model, [float(x) for x in rng.normal(size=8)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, f"{key} long, model string, vec array<double>")


def brute(q, c, k):
    out = set()
    for qi, qm, qv in q:
        s = [(-round(float(np.dot(qv, v) / np.linalg.norm(qv) / np.linalg.norm(v)), 12), i) for i, m, v in c if m == qm]
        out |= {(qi, i, r + 1) for r, (_, i) in enumerate(sorted(s)[:k])}
    return out


def test_knn_both_ways_against_brute_force(spark):
    q, qd = vectors(spark, 23, "query_id", 1)
    c, cd = vectors(spark, 400, "id", 2)
    other, od = vectors(spark, 50, "id", 3, "other")
    corpus = cd.unionAll(od.withColumn("id", F.col("id") + 1000))
    want = brute(q, c, 5)
    small = {(r.query_id, r.id, r["rank"]) for r in rt.knn(qd, corpus, 5).collect()}
    blocks = {(r.query_id, r.id, r["rank"]) for r in rt.knn(qd, corpus, 5, query_block=7).collect()}
    assert small == want and blocks == want


def test_zero_vectors_have_no_score(spark):
    q = spark.createDataFrame([(1, "m", [1.0, 0.0])], "query_id long, model string, vec array<double>")
    c = spark.createDataFrame([(1, "m", [0.0, 0.0]), (2, "m", [1.0, 1.0])], "id long, model string, vec array<double>")
    assert [r.id for r in rt.knn(q, c, 5).collect()] == [2]
    got = c.select(rt.cosine(F.array(F.lit(1.0), F.lit(0.0)), "vec").alias("s")).collect()
    assert got[0].s is None and abs(got[1].s - 2 ** -0.5) < 1e-12


def test_fuse_uses_available_fields_only(spark):
    df = spark.createDataFrame([(0.8, None), (0.8, 0.2), (None, None)], "a double, b double")
    got = [r[0] for r in df.select(rt.fuse_scores({"a": 3, "b": 1}, {"a": F.col("a"), "b": F.col("b")})).collect()]
    assert abs(got[0] - 0.8) < 1e-12 and abs(got[1] - 0.65) < 1e-12 and got[2] is None


def test_filters_exclude_conflicts_and_keep_unknown(spark):
    df = spark.createDataFrame([(1, "KR", 10, 20), (2, None, 10, 20), (3, "JP", 10, 20), (4, "KR", None, 20), (5, "KR", 30, 40), (6, "KR", None, 3)],
                               "id int, region string, s int, e int")
    out = rt.exact_filter(df, {"region": rt.filter_value(F.col("region"), F.lit("KR")),
                               "period": rt.filter_period(F.col("s"), F.col("e"), F.lit(5), F.lit(25))})
    assert {r.id: r.filter_state for r in out.collect()} == {1: "match", 2: "unknown", 4: "unknown"}


def test_concept_candidates(spark):
    s = spark.createDataFrame([("d", "a", 0.9), ("d", "a.b", 0.8), ("d", "c", 0.7), ("d", "z", 0.1), ("e", "a", 0.5), ("e", "a.b", 0.6), ("f", "a", 0.1)],
                              "dataset_id string, concept_id string, score double")
    tree = spark.createDataFrame([("a.b", "a")], "concept_id string, ancestor string")
    got = sorted((r.dataset_id, r.concept_id, r["rank"], round(r.margin, 3)) for r in rt.concept_candidates(s, 0.3, 2, tree).collect())
    assert got == [("d", "a", 1, 0.0), ("d", "c", 2, 0.2), ("e", "a.b", 1, 0.0)]


def test_retrieve_filters_before_ranking(spark):
    ranked = spark.createDataFrame([(1, 10, 0.9, ["m"]), (1, 11, 0.5, ["m"])], "query_id int, id int, score double, channels array<string>")
    md = spark.createDataFrame([(10, "JP", "t"), (11, "KR", "u")], "id int, region string, title string")
    out = rt.retrieve(ranked, md, {"region": rt.filter_value(F.col("region"), F.lit("KR"))}, 1).collect()
    assert [(r.id, r["rank"]) for r in out] == [(11, 1)] and out[0].retrieval_result_id.startswith("result-")


def test_metrics(spark):
    res = spark.createDataFrame([("q", "a", 1), ("q", "b", 2), ("q", "c", 3)], "query_id string, id string, rank int")
    jud = spark.createDataFrame([("q", "b", 3), ("q", "x", 1), ("n", "y", 0)], "query_id string, id string, grade int")
    r = {x.query_id: x for x in ev.query_metrics(res, jud).collect()}
    assert r["q"].recall_at_5 == 0.5 and r["q"].precision_at_5 == 0.2 and r["q"].reciprocal_rank == 0.5
    assert abs(r["q"].ndcg_at_10 - (3 / np.log2(3)) / (3 + 1 / np.log2(3))) < 1e-12
    assert r["n"].recall_at_5 is None and r["n"].ndcg_at_10 is None


def test_family_split_keeps_copies_together(spark):
    df = spark.createDataFrame([(i, f"Text  {i // 3}" if i % 2 else f"text {i // 3} ") for i in range(300)], "id int, text string")
    per = ev.family_split(df, "text").groupBy("family").agg(F.count_distinct("split").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert len(per) == 100 and all(r.s == 1 and r.n == 3 for r in per)


def test_log_has_no_query_text(spark, tmp_path):
    res = spark.createDataFrame([(1, "secret words", 5, 1, 0.5, "match")], "query_id int, query_text string, id int, rank int, score double, filter_state string")
    path = str(tmp_path / "log")
    log = ev.retrieval_log(res, "v", path)
    assert "query_text" not in log.columns and spark.read.parquet(path).count() == 1


def test_unknown_model_meets_none_on_either_path(spark):
    from catalith.operators import retrieval

    q = spark.createDataFrame([("q1", None, [1.0, 0.0]), ("q2", None, [1.0, 0.0])], "concept_id string, model string, vec array<double>")
    d = spark.createDataFrame([("d1", None, [1.0, 0.0])], "dataset_id string, model string, vec array<double>")
    for block in (1, 10):
        assert retrieval.concept_scores(d, q, 0.5, concept_block=block).count() == 0
