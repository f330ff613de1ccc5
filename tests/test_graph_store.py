"""The stored graph against direct matching, and its own comparison."""

import pytest
from pyspark.sql import functions as F

from catalith.operators import graph_store as gs
from catalith.operators import lexical as lx
from catalith.plans import model as m
from catalith.plans.registry import Tables

ALIASES = [("measure:rain", "Measure", "rain"), ("measure:rain", "Measure", "rainfall"), ("topic:water", "Topic", "water"), ("unit:mm", "Unit", "mm")]


def some_items(spark, rows):
    schema = ("record_id string, portal_id string, kind string, label string, name_en string, unit string, evidence_id string, ordinal int, "
              "locator string, source_url string, description string, datatype string, role string, is_control boolean")
    return spark.createDataFrame([(r, p, k, lab, None, u, "e", n, None, None, None, None, None, False) for n, (r, p, k, lab, u) in enumerate(rows)], schema)


@pytest.fixture(scope="module")
def rows():
    hot = [("r1", "p1", "documented_field", "rain", "mm")] * 40
    return hot + [("r2", "p1", "catalog_label", "water", None), ("r2", "p1", "documented_field", "water", None), ("r3", "p2", "declared_output", "rainfall", None)]


def test_tables_equal_direct_matching(spark, rows, tmp_path):
    items, aliases = some_items(spark, rows), spark.createDataFrame(ALIASES, "concept_id string, kind string, alias string")
    store = gs.build(items, aliases, (), str(tmp_path / "graph"))
    matched = lx.match_items(items, aliases, ())
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(store.portal_concepts) == key(lx.portal_concepts(matched))
    assert store.counts().first() == lx.graph_counts(matched).first()
    assert sorted(r["id"] for r in store.items.collect()) == list(range(1, len(rows) + 1))
    assert store.mappings.count() == 82  # 40 x (measure and unit), one topic, one output token; the field "water" has none
    assert {r["term"]: r["examples"] for r in store.terms.collect()}["rain"] == ["r1", "r1"]
    assert store.differences(store.mappings).count() == 0
    less = store.differences(store.mappings.filter("concept_id <> 'topic:water'")).collect()
    assert {(r["table"], r["side"]) for r in less} == {("mappings", "only_in_stored"), ("portal_concepts", "only_in_stored")}
    written = {p.name for p in (tmp_path / "graph").iterdir()}
    assert written == {"items", "mappings", "terms", "portal_concepts", "records"}
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        gs.build(items, aliases, (), str(tmp_path / "graph"))


def test_record_counts_join_without_exchange(spark, rows, tmp_path):
    store = gs.build(some_items(spark, rows), spark.createDataFrame(ALIASES, "concept_id string, kind string, alias string"), (), str(tmp_path / "g2"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = store.records.alias("a").join(store.records.alias("b"), "record_id")
        plan = both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and both.count() == 3


def test_empty_build(spark, tmp_path):
    store = gs.build(some_items(spark, [("r", "p", "catalog_label", "x", None)]).limit(0),
                     spark.createDataFrame([], "concept_id string, kind string, alias string"), (), str(tmp_path / "none"))
    assert store.items.count() == store.mappings.count() == store.portal_concepts.count() == store.terms.count() == 0


def test_queries_share_one_build(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    first = m.graph(t)
    assert m.graph(Tables(spark, "/root/testdata/sf0.001/")) is first
    assert all("/portal_concepts/" in f for f in first.portal_concepts.inputFiles())
    assert first.counts().select(F.col("source_items")).first()[0] == first.items.count()
