"""Filtered, paged and literal-safe searches over items, registrations and terms."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions import text as tx
from catalith.layout import page, page_count
from catalith.operators.lexical import KINDS
from catalith.sources.definitions import json_items, json_value

# Page sizes and the last page of the graph search.
GRAPH_PAGE, CATALOG_PAGE = 24, 25
MAX_GRAPH_PAGE = 1_000_000


@dataclass(frozen=True)
class SearchResult:
    """``rows`` is one page; ``matches`` is every match; totals are one-row tables."""

    rows: DataFrame
    matches: DataFrame
    page: int
    page_size: int

    def totals(self) -> DataFrame:
        return self.matches.agg(F.count(F.lit(1)).alias("total")).select(
            "total", page_count(F.col("total"), self.page_size).alias("pages"))


def _require(known: DataFrame, column: str, value: str, what: str) -> None:
    if not known.filter(F.col(column) == value).limit(1).count():
        raise ValueError(f"unknown {what}")


def _text(value: str | None) -> str:
    return (value or "").strip()


def search_items(
    items: DataFrame, *, portal: str = "", record: str = "", basis: str = "", q: str = "", concept: str = "",
    mode: str = "mapped", number: int = 1, portals: DataFrame | None = None, concepts: DataFrame | None = None,
    records: DataFrame | None = None,
) -> SearchResult:
    """Items (with ``concept_ids``) matching every given filter, in id order.

    Unknown portals, concepts, records, bases, modes and page numbers are
    errors.  A concept filter overrides ``mode``.
    """
    portal, record, basis, q, concept = map(_text, (portal, record, basis, q, concept))
    check_item_search(portal, record, basis, concept, mode, number, portals, concepts, records)
    out = items.filter(item_predicate(portal, record, basis, q, concept, mode)).withColumn("semantic_status", semantic_status())
    return SearchResult(page(out, ["id"], number, GRAPH_PAGE), out, number, GRAPH_PAGE)


def check_item_search(portal: str, record: str, basis: str, concept: str, mode: str, number: int, portals: DataFrame | None,
                      concepts: DataFrame | None, records: DataFrame | None) -> None:
    """Raise for filters and page numbers that the item search does not know."""
    if mode not in ("mapped", "all") or basis not in ("", *KINDS):
        raise ValueError("invalid graph filter")
    if not 1 <= number <= MAX_GRAPH_PAGE:
        raise ValueError("invalid graph page")
    if portal and portals is not None:
        _require(portals, "portal_id", portal, "portal")
    if concept and concepts is not None:
        _require(concepts, "id", concept, "concept")
    if record and records is not None:
        _require(records, "id", record, "record")


def item_predicate(portal: str, record: str, basis: str, q: str, concept: str, mode: str) -> Column:
    """Whether an item matches every given filter; a concept overrides ``mode``."""
    wanted = [F.lit(True)]
    if portal:
        wanted.append(F.col("portal_id") == portal)
    if record:
        wanted.append(F.col("record_id") == record)
    if basis:
        wanted.append(F.col("kind") == basis)
    if q:
        wanted.append(tx.contains_literal("label", q) | tx.contains_literal("name_en", q))
    if concept:
        wanted.append(F.array_contains("concept_ids", concept))
    elif mode == "mapped":
        wanted.append(F.size("concept_ids") > 0)
    return reduce(lambda x, y: x & y, wanted)


def semantic_status() -> Column:
    return F.when(F.size("concept_ids") > 0, F.lit("candidate_pending_human_review")).otherwise(
        F.lit("no_match_to_current_concept_draft"))


def item_counts(records: DataFrame, items: DataFrame) -> DataFrame:
    """Registrations with their number of items, zero included."""
    counts = items.groupBy(F.col("record_id").alias("id")).agg(F.count(F.lit(1)).alias("_n"))
    return records.join(counts, "id", "left").withColumn(
        "source_items", F.coalesce("_n", F.lit(0)).cast("long")).drop("_n")


def search_registrations(
    records: DataFrame, items: DataFrame, *, portal: str = "", q: str = "", number: int = 1,
    portals: DataFrame | None = None,
) -> SearchResult:
    """Registrations by portal and literal title text, with item counts."""
    portal, q = _text(portal), _text(q)
    if not 1 <= number <= MAX_GRAPH_PAGE:
        raise ValueError("invalid page")
    if portal and portals is not None:
        _require(portals, "portal_id", portal, "portal")
    out = records
    if portal:
        out = out.filter(F.col("portal_id") == portal)
    if q:
        out = out.filter(tx.contains_literal("title", q))
    rows = item_counts(page(out, ["id"], number, GRAPH_PAGE), items).orderBy("id")
    return SearchResult(rows, out, number, GRAPH_PAGE)


def header_records(documents: DataFrame, sources: DataFrame, field: str) -> DataFrame:
    """Registrations whose documents list ``field`` in a header or parameter candidate.

    ``documents(path, metadata VARIANT)``, ``sources(path, record_id)``.
    """
    heads = json_items("metadata", "$.header_candidates")
    lists = json_items("metadata", "$.declared_parameter_lists")
    names = F.concat(heads, F.flatten(F.transform(lists, lambda p: F.concat(
        json_items(p, "$.response_label_candidates"), json_items(p, "$.response_name_candidates")))))
    hit = documents.select("path", F.explode(names).alias("v")).select(
        "path", json_value("v", "$").alias("name")).filter(tx.contains_pattern("name", field))
    return hit.select("path").distinct().join(sources, "path").select("record_id")


def records_with_field(fields: DataFrame, documented: DataFrame, field: str,
                       documents: DataFrame | None = None, sources: DataFrame | None = None) -> DataFrame:
    """Distinct registrations in which ``field`` occurs as token, column or header."""
    out = fields.filter(tx.contains_pattern("name", field)).select("record_id").unionAll(
        documented.filter(tx.contains_pattern("name", field) | tx.contains_pattern("name_en", field)).select("record_id"))
    if documents is not None and sources is not None:
        out = out.unionAll(header_records(documents, sources, field))
    return out.distinct()


def search_catalog(
    records: DataFrame, fields: DataFrame, documented: DataFrame, *, portal: str = "", provider: str = "",
    q: str = "", field: str = "", documented_only: bool = False, number: int = 1,
    documents: DataFrame | None = None, sources: DataFrame | None = None,
) -> SearchResult:
    """Catalogue browser search; here ``%`` and ``_`` in texts do act as wildcards.

    A page below one is the first; a page after the last is empty.
    """
    portal, provider, q, field = map(_text, (portal, provider, q, field))
    number = max(1, number)
    out = records
    if portal:
        out = out.filter(F.col("portal_id") == portal)
    if provider:
        out = out.filter(tx.contains_pattern("provider_name", provider))
    if q:
        out = out.filter(tx.contains_pattern("title", q))
    if field:
        ids = records_with_field(fields, documented, field, documents, sources)
        out = out.join(ids.withColumnRenamed("record_id", "id"), "id", "left_semi")
    if documented_only:
        out = out.join(documented.select(F.col("record_id").alias("id")), "id", "left_semi")
    counts = documented.groupBy(F.col("record_id").alias("id")).agg(F.count(F.lit(1)).alias("documented_columns"))
    rows = page(out, ["portal_id", "id"], number, CATALOG_PAGE).join(counts, "id", "left").withColumn(
        "documented_columns", F.coalesce("documented_columns", F.lit(0)).cast("long")).orderBy("portal_id", "id")
    return SearchResult(rows, out, number, CATALOG_PAGE)


def item_detail(item_id: int, matched: DataFrame, records: DataFrame, terms: DataFrame, buckets: DataFrame,
                receipts: DataFrame) -> DataFrame:
    """One item with its registration, concepts, terms and public receipt fields."""
    one = matched.filter(F.col("id") == item_id)
    rec = records.select(F.col("id").alias("record_id"), F.struct("id", "portal_id", "title", "url").alias("record"))
    mine = terms.filter(F.col("item_id") == item_id).join(buckets, ["portal_id", "term_role", "term"])
    # One item carries at most three terms, so this list is bounded.
    gathered = mine.groupBy(F.col("item_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("term_role", "term", "occurrences"))).alias("source_terms"))
    public = receipts.select(F.col("id").alias("evidence_id"),
                             F.struct("id", "requested_url", "retrieved_at", "status", "sha256").alias("receipt"))
    return (one.join(rec, "record_id", "left").join(gathered, "id", "left").join(public, "evidence_id", "left")
            .withColumn("human_approved", F.lit(False)))


def record_detail(record_id: str, records: DataFrame, documented: DataFrame, tokens: DataFrame,
                  sources: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(registration, definitions, tokens, schema documents) of one registration."""
    def mine(df: DataFrame) -> DataFrame:
        return df.filter(F.col("record_id") == record_id)

    return (records.filter(F.col("id") == record_id), mine(documented).orderBy("evidence_id", "ordinal"),
            mine(tokens).orderBy("role", "ordinal"), mine(sources).select("path").distinct())
