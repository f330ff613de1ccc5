"""Comparison by digests of the stored graph with pairs recomputed from its source."""

import pytest
from pyspark.sql import functions as F

from catalith import layout
from catalith.operators import graph_store as gs
from catalith.operators import reconcile as rc
from catalith.plans import reconciling as pl
from tests.test_graph_store import some_items

SCHEMA = "a string, b string, n int"


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_digests_find_what_the_whole_comparison_finds(spark):
    rows = [("x", None, 1), (None, "x", 1), ("x", "y", 2), ("x", "y", 2), (None, None, None)] + [(f"k{i}", "v", i) for i in range(300)]
    stored = spark.createDataFrame(rows, SCHEMA)
    assert rc.digest_difference(stored, stored.repartition(3)).count() == 0
    # A lost copy, a null in another place, a changed value.
    other = spark.createDataFrame([r for i, r in enumerate(rows) if i not in (1, 2, 50)] + [("x", None, 1), ("k45", "w", 45)], SCHEMA)
    for groups in (1, 7, 4096):
        assert listed(rc.digest_difference(stored, other, groups)) == listed(rc.table_difference(stored, other))
    assert len(listed(rc.table_difference(stored, other))) == 5


def test_equal_tables_are_not_shuffled_whole(spark):
    stored = spark.range(20_000).selectExpr("cast(id as string) as a", "'v' as b", "cast(id as int) as n")
    out = rc.digest_difference(stored, stored)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 0 and "LocalRelation <empty>" in plan


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    aliases = spark.createDataFrame([("measure:rain", "Measure", "rain"), ("measure:rain", "Measure", "rainfall"), ("topic:water", "Topic", "water"),
                                     ("unit:mm", "Unit", "mm"), ("measure:open", "Measure", "open")], "concept_id string, kind string, alias string")
    items = some_items(spark, [("r1", "p1", "documented_field", "rain", "mm")] * 3 + [
        ("r2", "p1", "catalog_label", "water", None), ("r2", "p1", "documented_field", "water", None), ("r3", "Brand#2", "documented_field", "open", None)])
    items = items.withColumn("name_en", F.when(F.col("label") == "rain", F.lit("rainfall")).when(F.col("label") == "open", F.lit("O")))
    rule = gs.lx.ScopeRule("include", "Brand#2", "name_en", "O", "measure:open")
    path = str(tmp_path_factory.mktemp("graph") / "g")
    return gs.build(items, aliases, (rule,), path), pl._matched_again(items, aliases.withColumnRenamed("kind", "ckind"))


def test_a_concept_counts_once_an_item(store):
    # Both names of r1's fields name one concept, and so do a name and the rule of r3.
    assert sorted((r["record_id"], r["concept_id"]) for r in store[1].collect()) == [
        ("r1", "measure:rain")] * 3 + [("r1", "unit:mm")] * 3 + [("r2", "topic:water"), ("r3", "measure:open")]


def test_stored_graph_equals_its_source_and_differences_show(spark, store):
    graph, pairs = store
    assert graph.source_differences(pairs).count() == 0
    less = graph.source_differences(pairs.filter("concept_id <> 'topic:water'")).collect()
    assert {(r["table"], r["side"], r["concept_id"]) for r in less} == {
        ("items", "only_in_stored", "topic:water"), ("portal_concepts", "only_in_stored", "topic:water")}
    moved = graph.source_differences(pairs.withColumn("portal_id", F.when(F.col("record_id") == "r3", F.lit("p9")).otherwise(F.col("portal_id"))))
    assert {(r["table"], r["side"], r["portal_id"]) for r in moved.collect()} == {
        (t, s, p) for t in ("items", "portal_concepts") for s, p in (("only_in_stored", "Brand#2"), ("only_in_recomputed", "p9"))}
    other_item = pairs.withColumn("item", F.when(F.col("concept_id") == "unit:mm", F.col("item") + 1).otherwise(F.col("item")))
    assert {r["table"] for r in graph.source_differences(other_item).collect()} == {"items"}


def test_a_wrong_mapping_or_aggregate_shows(spark, store, tmp_path):
    graph, pairs = store
    wrong = gs.GraphStore(spark, graph.path)
    wrong._schemas, wrong._offsets = dict(graph._schemas), None
    wrong.path = str(tmp_path / "wrong")
    for name, change in (("items", None), ("mappings", "concept_id <> 'unit:mm' or item_id % 2 = 0"), ("portal_concepts", "kind <> 'catalog_label'")):
        table = spark.read.parquet(f"{graph.path}/{name}")
        (table.filter(change) if change else table).write.parquet(f"{wrong.path}/{name}")
    found = wrong.source_differences(pairs).collect()
    assert {r["table"] for r in found} == {"mappings", "portal_concepts"}
    assert {r["concept_id"] for r in found if r["table"] == "mappings"} == {"unit:mm"}


def test_a_table_of_keys_is_joined_without_sorting_the_rows(spark, monkeypatch):
    rows, keys = spark.range(1000).selectExpr("id % 10 as k", "id"), spark.range(5).selectExpr("id as k", "id * 2 as v")
    want = listed(rows.join(keys, ["k"]))
    joined = layout.dictionary_join(rows, keys, ["k"], salts=1, fits=False)
    assert "ShuffledHashJoin" in joined._jdf.queryExecution().executedPlan().toString() and listed(joined) == want
    monkeypatch.setattr(layout, "BROADCAST_ROWS", 0)
    merged = layout.dictionary_join(rows, keys, ["k"], salts=1, fits=False)
    assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString() and listed(merged) == want
