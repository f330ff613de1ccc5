"""The stored graph computes its items once and its small samples from ids."""

from catalith.operators import graph_store as gs
from catalith.operators import lexical as lx
from tests.test_graph_store import ALIASES, some_items


def test_items_are_computed_once_and_numbered_in_scan_order(spark, tmp_path, monkeypatch):
    read = []
    monkeypatch.setattr(gs, "place_rows", lambda df, order, f=gs.place_rows: read.append(df.inputFiles()) or f(df, order))
    rows = [(f"r{k % 7}", "p1", "documented_field", f"l{k}", "mm") for k in range(50)] + [("r9", "p2", "catalog_label", "water", None)]
    store = gs.build(some_items(spark, rows), spark.createDataFrame(ALIASES, "concept_id string, kind string, alias string"), (), str(tmp_path / "g"))
    assert read and read[0]  # the range partitions are drawn from written rows, not from a second computation
    got = store.items.orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 52)) and got[0]["label"] == "water"
    fields = [(r["record_id"], r["ordinal"]) for r in got[1:]]
    assert fields == sorted(fields)
    assert store.items.columns[0] == "id" and not {"_pid", "_pos"} & set(store.items.columns)


def test_term_counts_equal_the_buckets(spark, tmp_path):
    rows = [("r1", "p1", "documented_field", "rain", "mm")] * 3 + [("r2", "p2", "documented_field", "water", None)]
    store = gs.build(some_items(spark, rows), spark.createDataFrame(ALIASES, "concept_id string, kind string, alias string"), (), str(tmp_path / "g"))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(store.term_counts) == key(store.terms.drop("examples").select(*store.term_counts.columns))
    assert not [c for c in lx.term_counts(lx.item_terms(store.items))._jdf.queryExecution().optimizedPlan().toString().split() if c.startswith("Window")]
