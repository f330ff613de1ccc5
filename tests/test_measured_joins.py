"""Joins of tables that were measured as large, or never measured, use no broadcast."""

from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.layout import dictionary_join, shuffle_join
from catalith.operators import expand as ex
from catalith.operators import joins as jn


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_dictionary_beyond_the_limit_is_not_broadcast(spark):
    big = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = materialize(spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("w")), "small")
    for salts in (16, 1):
        for how, rows in (("inner", 50), ("left", 100), ("left_semi", 50), ("left_anti", 50)):
            out = dictionary_join(big, small, ["k"], how, rows=10, salts=salts)
            assert "Broadcast" not in plan(out)
            assert out.count() == rows
    assert "BroadcastHashJoin" in plan(dictionary_join(big, small, ["k"], rows=50))


def test_large_reference_keys_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("catalith.layout.fits_broadcast", lambda *a: False)
    links = spark.createDataFrame([("u/1",), ("u/9",), ("none",)], "url string")
    records = spark.createDataFrame([("r1", "p", "1"), ("r0", "p", "1")], "id string, portal_id string, dataset_key string")
    out = jn.resolve_references(links, records, "url", "^u/([0-9]+)$", "p")
    assert "Broadcast" not in plan(out)
    assert {(r["url"], r["resolved"], r["first_target"]) for r in out.collect()} == {("u/1", True, "r0"), ("u/9", False, None), ("none", False, None)}


def test_closure_of_many_steps_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("catalith.layout.fits_broadcast", lambda *a: False)
    monkeypatch.setattr("catalith.operators.expand.fits_broadcast", lambda *a: False)
    plans = []
    monkeypatch.setattr("catalith.operators.expand.materialize", lambda df, tag: plans.append(plan(df)) or materialize(df, tag))
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "c string, p string")
    out = {(r["node"], r["ancestor"]): r["hops"] for r in ex.closure(pairs, "c", "p").collect()}
    assert out[("d", "c")] == 3 and out[("a", "a")] == 0 and len(out) == 13
    assert not any("Broadcast" in p for p in plans)


def test_shuffle_join_keeps_the_join_kind(spark):
    a, b = spark.range(4), spark.range(2)
    assert shuffle_join(a, b, ["id"], "left_anti").count() == 2
