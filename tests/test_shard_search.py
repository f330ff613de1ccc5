"""Paged search on published shards against the search over all items."""

import re

import pytest
from pyspark.sql import functions as F

from catalith.operators import search as se
from catalith.operators import shard_search as sh


@pytest.fixture(scope="module")
def items(spark):
    concept = F.when(F.col("id") % 3 == 0, F.array(F.lit("c:a"))).when(F.col("id") % 7 == 0, F.array(F.lit("c:b"), F.lit("c:a"))).otherwise(F.array().cast("array<string>"))
    kinds = F.element_at(F.array(*(F.lit(k) for k in se.KINDS)), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(1, 1001).select("id", F.format_string("r%03d", (F.col("id") / 9).cast("int")).alias("record_id"),
                                       F.concat(F.lit("p"), (F.col("id") / 300).cast("int").cast("string")).alias("portal_id"), kinds.alias("kind"),
                                       F.concat(F.lit("Name "), F.col("id").cast("string")).alias("label"), F.lit(None).cast("string").alias("name_en"), concept.alias("concept_ids"))


@pytest.fixture(scope="module")
def store(items, tmp_path_factory):
    return sh.publish(items, str(tmp_path_factory.mktemp("shards") / "s"), 50)


@pytest.mark.parametrize("filters", [
    {"mode": "all", "number": 40}, {"number": 9}, {"portal": "p2", "number": 3}, {"basis": "declared_output", "mode": "all", "number": 2},
    {"concept": "c:b", "portal": "p1"}, {"concept": "c:b", "q": "nAmE 1", "number": 1}, {"record": "r033", "mode": "all"}, {"q": "99", "mode": "all"},
    {"record": "r033", "concept": "c:a", "portal": "p0"}, {"q": "%", "mode": "all"}, {"number": 900000}, {"portal": "p9"}])
def test_page_equals_the_full_search(items, store, filters):
    want, got = se.search_items(items, **filters), sh.search_shards(store, **filters)
    assert [r.asDict() for r in got.rows.select(want.rows.columns).collect()] == [r.asDict() for r in want.rows.collect()]
    assert got.totals().first() == want.totals().first()
    assert len(got.shards) <= got.page_size


def test_scan_lists_the_chosen_partitions(store):
    got = sh.search_shards(store, mode="all", number=21)
    assert 1 <= len(got.shards) <= 2
    plan = got.rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*shard#\d+", plan)
    read = {int(m.group(1)) for m in (re.search(r"shard=(\d+)", f) for f in store.items.filter(F.col("shard").isin(list(got.shards))).inputFiles()) if m}
    assert set(got.shards) <= read


def test_wrong_filters_are_errors(store):
    for bad in ({"mode": "some"}, {"basis": "x"}, {"number": 0}, {"number": 1_000_001}):
        with pytest.raises(ValueError):
            sh.search_shards(store, **bad)


def test_empty_items(items, tmp_path):
    got = sh.search_shards(sh.publish(items.limit(0), str(tmp_path / "none")), mode="all")
    assert got.rows.count() == 0 and got.shards == () and got.totals().first()["total"] == 0
