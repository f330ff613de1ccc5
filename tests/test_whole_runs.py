"""Scored runs are whole: a first relevant document below place 50 counts."""

from types import SimpleNamespace

from catalith.plans import ranking


def test_runs_are_not_cut(spark):
    docs = spark.createDataFrame([(f"d{i:03}", s, 1000 - i) for i in range(60) for s in ("a", "b")], "doc_id string, source string, n_chars int")
    docs = docs.selectExpr("concat(source, doc_id) as doc_id", "source", "n_chars")
    labels = spark.createDataFrame([("ad055", 1, 0), ("ad003", 0, 0), ("bd001", 1, 1)], "doc_id string, quality int, toxic int")
    t = SimpleNamespace(documents=docs, labels=labels)
    got = {r["query_id"]: r["reciprocal_rank"] for r in ranking.eval_metrics(t).collect()}
    assert got == {"a": round(1 / 56, 6), "b": 0.5}
    assert ranking.slices(t).collect()[0]["mrr"] == round((1 / 56 + 0.5) / 2, 6)
