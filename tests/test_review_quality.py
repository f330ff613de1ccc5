import random

import pytest
from pyspark.sql import functions as F

from catalith.operators import joins as jn
from catalith.operators import quality as qa
from catalith.operators import review as rv
from catalith.operators import scan as sc

METRICS = ("source_identity boolean, methodology boolean, definitions_and_units boolean, revision_policy boolean, "
           "covered_unique_units double, expected_unique_units double, valid_required_values double, expected_required_values double, "
           "applicability string, overdue_release_cycles double, not_applicable_reason string")


def metrics(spark, *rows):
    return spark.createDataFrame(list(rows), METRICS)


def test_scores(spark):
    full = (True, True, True, False, 70.0, 100.0, 80.0, 100.0, "applicable", 0.3, None)
    partial = (True, None, True, True, 0.0, 10.0, None, 10.0, "applicable", 10.0, None)
    zero = (
        None, None, None, None, 0.0, 0.0, None, None, "not_applicable", None, "final release")
    r = qa.score_qa(metrics(spark, full, partial, zero)).collect()
    assert [round(r[0][c], 2) for c in ("reliability", "coverage", "freshness", "completeness", "overall_score")] == [7.5, 7.0, 9.0, 8.0, 7.8]
    assert r[0].status == "assessed" and r[1].status == "partial" and r[2].status == "not_assessed"
    assert r[1].reliability is None and r[1].coverage == 0.0 and r[1].freshness == 0.0 and r[1].overall_score is None
    assert r[1].assessment_completion_ratio == 0.5 and r[2].coverage is None


@pytest.mark.parametrize("change,text", [
    ({4: -1.0}, "nonnegative"), ({4: 0.5}, "integers"), ({4: 200.0}, "denominator"), ({9: float("nan")}, "nonnegative"),
    ({8: "not_applicable"}, "reason"), ({8: "sometimes"}, "applicability"), ({5: float("inf")}, "nonnegative")])
def test_metric_rejections(spark, change, text):
    row = [True, True, True, True, 5.0, 10.0, 5.0, 10.0, "applicable", 0.0, None]
    for i, v in change.items():
        row[i] = v
    df = metrics(spark, tuple(row))
    soft = qa.score_qa(df, strict=False).collect()[0]
    assert text in "; ".join(soft.errors) and soft.overall_score is None
    with pytest.raises(Exception, match=text):
        qa.score_qa(df).collect()


def run(events, initial="proposed"):
    state, out = initial, []
    for claimed, to in events:
        ok = to in rv.TRANSITIONS[state] and claimed in (None, state)
        out.append((state, to if ok else state, ok))
        state = to if ok else state
    return out


def test_state_machine_with_a_hot_proposal(spark):
    rnd = random.Random(3)
    words = list(rv.STATES[1:]) + ["approved", "stale", "under_review"] * 4
    rows, want = [], {}
    for pid, n in (("hot", 3000), ("a", 7), ("b", 1), ("c", 300)):
        ev = [(rnd.choice([None, None, "approved", "proposed", "under_review"]), rnd.choice(words if pid == "a" else words[-12:]))
              for _ in range(n)]
        rows += [(pid, i, c, t) for i, (c, t) in enumerate(ev)]
        want[pid] = run(ev)
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "p string, seq int, frm string, to string")
    out = rv.apply_review_events(df, "p", ["seq"], "to", "frm")
    got = {}
    for r in out.orderBy("p", "seq").collect():
        got.setdefault(r.p, []).append((r.state_before, r.state_after, r.accepted))
    assert got == want
    cur = {r.p: r.state for r in rv.current_states(out, "p", ["seq"]).collect()}
    assert cur == {k: v[-1][1] for k, v in want.items()}


def test_scan_carries_over_many_chunks(spark):
    df = spark.range(0, 5000).select(F.lit("x").alias("b"), F.col("id").alias("i"), F.when(F.col("id").isin(3, 4000), F.col("id")).alias("v"))
    got = {r.i: r.c for r in sc.carry_down(df, "b", ["i"], F.col("v"), "c", chunk=16).collect()}
    assert got[2] is None and got[3] == 3 and got[3999] == 3 and got[4999] == 4000


def test_heading_scope(spark):
    rows = [(1, None, "t0"), (2, 3, "S1"), (3, None, "t1"), (4, 4, "op"), (5, None, "t2"), (6, 4, "출력결과"), (7, None, "t3"), (8, 3, "S2"), (9, None, "t4")]
    df = spark.createDataFrame([("p", *r) for r in rows], "page string, pos int, level int, label string")
    got = {r.label: (r.section, r.operation) for r in sc.heading_scope(df, "page", "pos", "level", "label", ("출력결과",)).collect()}
    assert got["t0"] == (None, None) and got["t1"] == ("S1", None) and got["t2"] == ("S1", "op") and got["t3"] == ("S1", "op")
    assert got["t4"] == ("S2", None)


def test_review_queue_survives_absence(spark):
    sample = spark.createDataFrame([("m1", "pending", None), ("m2", "pending", None)], "id string, status string, decision string")
    q = spark.createDataFrame([("m1", "done", "approve"), ("m3", "done", "reject")], "id string, status string, decision string")
    none = spark.createDataFrame([], "id string, status string, decision string")
    items, outside = rv.carry_reviews(sample, q, none)
    assert {r.id: r.decision for r in items.collect()} == {"m1": "approve", "m2": None}
    assert [(r.id, r.decision) for r in outside.collect()] == [("m3", "reject")]
    back, rest = rv.carry_reviews(sample.unionAll(spark.createDataFrame([("m3", "pending", None)], sample.schema)), items.select("id", "status", "decision"), outside)
    assert {r.id: r.decision for r in back.collect()}["m3"] == "reject" and rest.count() == 0


def test_invalidate_and_approval(spark):
    a = spark.createDataFrame([(1, "approved", "x", None), (2, "approved", "x", "s"), (3, "approved", "x", "s"), (4, "proposed", "x", "s")], "id int, state string, fp string, src string")
    c = spark.createDataFrame([(1, "x", None), (2, "y", "s"), (4, "z", "s")], "id int, fp string, src string")
    got = {r.id: (r.state_now, r.triggers) for r in rv.invalidate(a, c, ["fp", "src"]).collect()}
    assert got == {1: ("approved", []), 2: ("stale", ["fp_changed"]), 3: ("stale", ["evidence_withdrawal"]), 4: ("proposed", ["fp_changed"])}


def test_crosswalk_keeps_duplicates_and_flags_ambiguity(spark):
    df = spark.createDataFrame([("A", "2020-01-01"), ("A", "2020-01-01"), ("B", "2020-01-01"), ("C", "2020-01-01")], "code string, d string")
    x = spark.createDataFrame([("A", "a1", "2019-01-01", None), ("B", "b1", "2019-01-01", None), ("B", "b2", "2019-06-01", "2021-01-01")],
                              "code string, target_code string, valid_from string, valid_to string")
    got = sorted((r.code, r.target_code or "", r.crosswalk_status) for r in jn.crosswalk_join(df, x, "code", "d").collect())
    assert got == [("A", "a1", "match"), ("A", "a1", "match"), ("B", "", "ambiguous"), ("C", "", "unknown")]


def test_join_assessment_null_keys(spark):
    left = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    r = jn.assess_join(left, right, ["k"], ["k"], units_aligned=None).collect()[0]
    assert (r.left_rows, r.left_rows_without_key, r.matched_keys, r.joined_rows, r.cardinality) == (4, 1, 1, 4, "many_to_many")
    assert r.left_coverage == 0.5 and r.duplicate_expansion == 2 and r.units_aligned is None and r.join_permitted is False
    one = jn.assess_join(spark.createDataFrame([], "k int"), right, ["k"], ["k"]).collect()[0]
    assert one.joined_rows == 0 and one.left_coverage is None


def test_site_summary_and_gate(spark):
    df = spark.createDataFrame([("s", 1.0, "d1"), ("s", 3.0, "d2"), ("s", None, "d3")], "site string, overall_score double, assessed_at string")
    r = qa.site_summary(df, ("site",)).collect()[0]
    assert (r.registered_dataset_count, r.assessed_dataset_count, r.median_score) == (3, 2, 2.0)
    g = spark.createDataFrame([("pass", "pass"), ("fail", None), (None, "pass")], "a string, b string")
    ok = F.lit("pass")
    assert [r[0] for r in g.select(qa.gate(F.col("a"), F.col("b"), ok, ok)).collect()] == ["pass", "fail", "unknown"]
