"""Review queue, service matches, approval fields, shown scores, documents without fields, resource objects, subtotals."""

import json
import time

import pandas as pd
from pyspark.sql import functions as F

from catalith.operators import quality as qa
from catalith.operators import registry as rg
from catalith.operators import review as rv
from catalith.sinks import triples as tr
from catalith.sources import definitions as df
from catalith.streaming import live


def test_review_queue_and_services(spark):
    leads = spark.createDataFrame([("1", "https://b.kr/x", False), ("2", "https://a.kr/n", True), ("3", "https://www.a.kr/y", None),
                                   ("4", "nothing", True)], "id string, url string, likely_notice boolean")
    assert {r.id: r.place for r in rg.review_queue(leads).collect()} == {"1": 1, "3": 2, "2": 3, "4": 4}
    known = spark.createDataFrame([("s1", "https://a.kr/", "https://c.kr/"), ("s2", "http://www.a.kr", None), ("s3", None, None)],
                                  "service string, asked string, final string")
    hosts = rg.service_hosts(known, "service", "asked", "final")
    assert sorted(map(tuple, hosts.collect())) == [("a.kr", "s1"), ("a.kr", "s2"), ("c.kr", "s1")]
    got = {r.id: (r.services, r.first_service) for r in rg.lead_services(leads, hosts).collect()}
    assert got == {"1": (0, None), "2": (2, "s1"), "3": (2, "s1"), "4": (0, None)}
    assert rg.review_queue(leads.limit(0)).count() == 0


def test_approval_of_each_kind(spark):
    base = {c: "x" for c in rv.APPROVAL_FIELDS} | {"actor_kind": "human"}
    full = {c: "x" for f in rv.EXTRA_FIELDS.values() for c in f}
    rows = [base | full | {"kind": "statistical_relation"}, base | full | {"kind": "statistical_relation", "uncertainty": ""},
            base | full | {"kind": "semantic_topic", "uncertainty": None}, base | full | {"kind": None, "code_hash": None}]
    names = sorted(rows[0])
    out = rv.approval_valid(spark.createDataFrame([[r[c] for c in names] for r in rows], ", ".join(f"{c} string" for c in names)), kind="kind")
    assert [(r.valid, r.missing_fields) for r in out.collect()] == [(True, []), (False, ["uncertainty"]), (True, []), (True, [])]
    bare = spark.createDataFrame([["x"] * 7 + ["human", "semantic_topic"]], ", ".join(f"{c} string" for c in (*rv.APPROVAL_FIELDS, "actor_kind", "kind")))
    assert rv.approval_valid(bare, kind="kind").first().missing_fields == [c for c in rv.EXTRA_FIELDS["semantic_topic"] if c != "applicability_scope"]


def test_shown_scores_and_subtotals(spark):
    d = spark.createDataFrame([(10 / 3, 2.005, None, 1.0, 4.4444)], "reliability double, coverage double, freshness double, completeness double, overall_score double")
    assert tuple(qa.displayed_scores(d).first()) == (3.33, 2.01, None, 1.0, 4.44)
    rows = [("a", None, 1.0), ("a", "t", 2.0), ("b", "t", None)]
    a = spark.createDataFrame(rows, "site string, topic string, overall_score double").withColumn("assessed_at", F.lit("d"))
    got = {(r.level, r.site, r.topic): (r.registered_dataset_count, r.median_score)
           for r in qa.site_summary(a, ("site", "topic"), subtotals=True).collect()}
    assert got == {(0, "a", None): (1, 1.0), (0, "a", "t"): (1, 2.0), (0, "b", "t"): (1, None), (1, "a", None): (2, 1.5),
                   (1, "b", None): (1, None), (2, None, None): (3, 1.5)}


def test_documents_without_fields_are_reported(spark):
    docs = spark.createDataFrame([(k, json.dumps({"portal_id": "p", "dataset_key": k, "fields": f}))
                                  for k, f in (("a", []), ("b", [{"name": "x"}]), ("c", []))], "path string, t string")
    docs = docs.select("path", F.parse_json("t").alias("doc"), F.lit(None).cast("string").alias("error"))
    records = spark.createDataFrame([("r1", "p", "c", "FILE")], "id string, portal_id string, dataset_key string, kind string")
    assert sorted(r.path for r in df.unmatched_documents(df.definition_heads(docs), records).collect()) == ["a", "b"]


def test_objects_that_name_resources(spark):
    t = spark.createDataFrame([("c 1", "rdf:type", "Claim"), ("n", "skos:prefLabel", 'a "b"\n'), ("n", "dcat:theme", "topic/1")], "s string, p string, o string")
    got = [r[0] for r in t.select(tr.nt_line(F.col("s"), F.col("p"), F.col("o"), "https://x/", tr.names_resource(F.col("p")))).collect()]
    assert got == ["<https://x/c+1> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <https://x/Claim> .",
                   '<https://x/n> <http://www.w3.org/2004/02/skos/core#prefLabel> "a \\"b\\"\\n" .',
                   "<https://x/n> <http://www.w3.org/ns/dcat#theme> <https://x/topic%2F1> ."]


EVENTS = "proposal_id string, seq long, to_state string"


def _rows(spark, name):
    return [tuple(r) for r in spark.table(name).collect()]


def test_review_order_over_many_frames(spark, tmp_path):
    seq = ["under_review", "approved", "stale", "under_review", "rejected", "superseded", "approved"]
    rows = [(p, i, seq[(i * step) % len(seq)]) for p, step in (("a", 1), ("b", 3)) for i in range(400)]
    path = str(tmp_path / "in")
    spark.createDataFrame(pd.DataFrame(rows, columns=["proposal_id", "seq", "to_state"]).sample(frac=1, random_state=1), EVENTS).coalesce(1).write.parquet(path)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "16")
    try:
        q = live.review_state_stream(spark.readStream.schema(EVENTS).parquet(path)).writeStream.format("memory").queryName(
            "frames").outputMode("append").trigger(availableNow=True).start()
        assert q.awaitTermination(60)
    finally:
        spark.conf.set(key, before)
    want = rv.apply_review_events(spark.createDataFrame(rows, EVENTS), "proposal_id", ["seq"], "to_state")
    want = [(*r, False) for r in want.select("proposal_id", "seq", "to_state", "state_before", "state_after", "accepted").collect()]
    assert sorted(_rows(spark, "frames")) == sorted(want)


def test_approval_outlives_its_ttl_and_late_events_are_told(spark, tmp_path):
    path = str(tmp_path / "in")

    def put(rows):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)

    def wait(n):
        # A stream with such timeouts runs on by itself, so it never reports that all is processed.
        end = time.time() + 40
        while len(got := _rows(spark, "ttl")) < n and time.time() < end:
            time.sleep(0.2)
        return {r[:2]: r[2:] for r in got[-4:]}

    put([("a", 1, "under_review"), ("a", 2, "approved")])
    q = live.review_state_stream(spark.readStream.schema(EVENTS).parquet(path), ttl_ms=1).writeStream.format("memory").queryName(
        "ttl").outputMode("append").start()
    try:
        wait(2)
        put([("z", 1, "under_review"), ("z", 2, "no such state"), ("z", None, "rejected")])
        wait(5)
        time.sleep(2)
        put([("a", 2, "revoked"), ("a", 3, "revoked"), ("z", 3, None), ("z", 4, "approved")])
        got = wait(9)
    finally:
        q.stop()
    assert got[("a", 2)] == ("revoked", "approved", "approved", False, True)
    assert got[("a", 3)] == ("revoked", "approved", "revoked", True, False)
    assert got[("z", 3)] == (None, "under_review", "under_review", False, False)
    assert got[("z", 4)] == ("approved", "under_review", "approved", True, False)
