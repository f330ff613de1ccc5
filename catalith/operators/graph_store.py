"""The concept graph built once and read many times.

``build`` matches the source items against the vocabulary and stores them in scan order
with the place that gives their dense ids; mappings, terms and aggregates are derived from the stored items,
each written at its first use.  Queries then read tables instead of matching again.

Items and mappings are clustered by the range partitions of the numbering (item kind, then
record), so a look-up by record or kind reads few row groups, and a record that holds a
third of all items is spread over several partitions, which bucketing by record would put
into one.  ``records`` has one row per record and is bucketed by it: joins of per-record
counts need no exchange.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.durable import materialize, scratch_root
from catalith.layout import numbered, place_offsets, place_rows
from catalith.operators import lexical as lx
from catalith.operators.reconcile import digest_difference, row_hash, table_difference

#: Rows of the per-record table for one bucket, and buckets at most.
BUCKET_ROWS, MAX_BUCKETS = 1_000_000, 4096
_GROUP = ("portal_id", "concept_id", "kind")
#: What tells source items apart; ids are given by the numbering only.
ITEM_KEY = ("kind", "record_id", "evidence_id", "ordinal", "locator", "label", "name_en", "unit", "role")


def item_hash() -> Column:
    """64-bit hash of what tells a source item apart."""
    return row_hash(*ITEM_KEY)


class GraphStore:
    """Tables of one build under ``path``; every table is written once and then only read."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._schemas: dict[str, object] = {}
        self._offsets: DataFrame | None = None

    def _table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        place = f"{self.path}/{name}"
        if name not in self._schemas:
            made = make()
            made.write.mode("errorifexists").parquet(place)
            self._schemas[name] = made.schema
        return self.spark.read.schema(self._schemas[name]).parquet(place)

    @property
    def items(self) -> DataFrame:
        """``id``, the item columns and ``concept_ids``."""
        if "items" not in self._schemas:
            raise ValueError("nothing stored here: use build")
        placed = self.spark.read.schema(self._schemas["items"]).parquet(f"{self.path}/items")
        if self._offsets is None:
            self._offsets = materialize(place_offsets(placed), "item-offsets")
        out = numbered(placed, self._offsets, "id")
        return out.select("id", *[c for c in out.columns if c != "id"])

    @property
    def mappings(self) -> DataFrame:
        """One row per item and concept, a candidate awaiting review."""
        return self._table("mappings", lambda: self.items.select(
            F.col("id").alias("item_id"), "record_id", "portal_id", "kind", F.explode("concept_ids").alias("concept_id")))

    @property
    def terms(self) -> DataFrame:
        """Occurrences and first examples of each (portal, role, term)."""
        return self._table("terms", lambda: lx.term_buckets(lx.item_terms(self.items)))

    @property
    def term_counts(self) -> DataFrame:
        """Occurrences of each (portal, role, term), without examples."""
        return self._table("term_counts", lambda: lx.term_counts(lx.item_terms(self.items)))

    @property
    def portal_concepts(self) -> DataFrame:
        """Occurrences and distinct records of each (portal, concept, item kind)."""
        return self._table("portal_concepts", lambda: lx.concept_counts(self.mappings))

    @property
    def records(self) -> DataFrame:
        """Counts of each record: items, mapped items, pairs, control fields, items by kind; bucketed by record."""
        name = "records_" + self.path.rsplit("/", 1)[-1].replace("-", "_")
        if "records" not in self._schemas:
            per = lx.record_counts(self.items)
            buckets = min(MAX_BUCKETS, -(-max(1, self.items.count()) // BUCKET_ROWS))
            (per.repartition(buckets, "record_id").write.bucketBy(buckets, "record_id").sortBy("record_id")
             .option("path", f"{self.path}/records").saveAsTable(name))
            self._schemas["records"] = per.schema
        return self.spark.table(name)

    def counts(self) -> DataFrame:
        """One row of totals, from the per-record counts."""
        return lx.record_totals(self.records)

    def differences(self, recomputed: DataFrame) -> DataFrame:
        """Mappings and aggregate rows that differ from ``recomputed(item_id, record_id, portal_id, kind, concept_id)``."""
        names = ["item_id", "record_id", "portal_id", "kind", "concept_id"]
        pairs = table_difference(self.mappings.select(*names), recomputed.select(*names)).select(
            F.lit("mappings").alias("table"), *_GROUP, "side", "copies")
        again = lx.concept_counts(recomputed)
        sums = table_difference(self.portal_concepts, again.select(*self.portal_concepts.columns)).select(
            F.lit("portal_concepts").alias("table"), *_GROUP, "side", "copies")
        return pairs.unionByName(sums)

    def source_differences(self, pairs: DataFrame) -> DataFrame:
        """Items' concepts, mappings and aggregate rows that differ from ``pairs``, recomputed from the source.

        ``pairs(item, record_id, portal_id, kind, concept_id)`` has the ``item_hash`` of each match and no ids, so it need not
        be joined with the stored items: it is compared with their concepts by digests, and these with the stored mappings.
        Aggregates of equal pairs are equal: they are counted again from the items' concepts, and from ``pairs`` where
        those differ.
        """
        found = self.items.select(F.col("id").alias("item_id"), item_hash().alias("item"), "record_id", "portal_id", "kind",
                                  F.explode("concept_ids").alias("concept_id"))
        names = ["item", "portal_id", "kind", "concept_id"]
        items = materialize(digest_difference(found.select(*names), pairs.select(*names)).select(
            F.lit("items").alias("table"), *_GROUP, "side", "copies"), "item-differences")
        names = ["item_id", "record_id", "portal_id", "kind", "concept_id"]
        mapped = digest_difference(self.mappings.select(*names), found.select(*names)).select(
            F.lit("mappings").alias("table"), *_GROUP, "side", "copies")
        again = lx.concept_counts(pairs if items.limit(1).count() else found)
        sums = table_difference(self.portal_concepts, again.select(*self.portal_concepts.columns)).select(
            F.lit("portal_concepts").alias("table"), *_GROUP, "side", "copies")
        return items.unionByName(mapped).unionByName(sums)


def build(items: DataFrame, aliases: DataFrame, rules: Sequence[lx.ScopeRule] = lx.SCOPE_RULES, path: str | None = None) -> GraphStore:
    """Number, match and store ``items``; other tables of the store follow at their first use.

    ``path`` defaults to a new folder under ``spark.checkpoint.dir``; it must not hold a build yet.
    """
    spark = items.sparkSession
    store = GraphStore(spark, path or f"{scratch_root(spark)}/graph_{uuid.uuid4().hex}")
    # Written once before they are ordered: range partitions are drawn from a first pass over the rows.
    matched = materialize(lx.match_items(items, aliases, rules), "matched")
    store._table("items", lambda: place_rows(matched, lx.scan_order()))
    return store
