"""Source items, exact alias matching and the aggregates over the matches.

A match is a candidate: the same label is not the same concept until a person
approves it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.functions import text as tx
from catalith.layout import dense_row_number, dictionary_join, fits_broadcast, shuffle_join
from catalith.sources.definitions import json_value

# Item kinds in scan order, control roles and envelope names.
KINDS = ("catalog_label", "documented_field", "declared_output")
CONTROL_ROLES = ("response_envelope", "response_control", "api_response_control", "error_response")
CONTROL_NAMES = ("resultCode", "resultMsg", "resultMgs", "list_total_count", "RESULT.CODE",
                 "RESULT.MESSAGE", "totalCount", "numOfRows", "pageNo")
CATEGORY_KEYS = ("category_raw", "source_category", "source_classification_label")
NESTED_CATEGORY_KEYS = ("topCateNm", "topCateNm2", "cl_nm", "cl_cd_nm")
NESTED_KEYWORD_KEYS = ("kwrd_one", "kwrd_two", "kwrd_three")
# Defaults of the evidence sample.
SAMPLE_PER_CONCEPT, SAMPLE_PER_PORTAL = 12, 2

ITEM_COLUMNS = ("record_id", "portal_id", "kind", "label", "name_en", "unit", "evidence_id", "ordinal",
                "locator", "source_url", "description", "datatype", "role", "is_control")


@dataclass(frozen=True)
class ScopeRule:
    """Portal-scoped exception to the alias table.

    ``exclude`` removes ``concept_id`` from items whose ``field`` equals
    ``value`` outside ``portal``; ``include`` adds it inside ``portal``.
    """

    action: str
    portal: str
    field: str
    value: str
    concept_id: str


# The shipped exceptions.
SCOPE_RULES = (
    ScopeRule("exclude", "neis", "label", "행정표준코드", "identifierscheme:school-code"),
    ScopeRule("include", "hrfco", "name_en", "RF", "measure:precipitation"),
    ScopeRule("include", "hrfco", "name_en", "WL", "measure:water-level"),
)


def is_control(role: Column, name_en: Column) -> Column:
    """Envelope and paging fields: kept as items, left out of concept matching."""
    return F.coalesce(role.isin(*CONTROL_ROLES), F.lit(False)) | F.coalesce(
        name_en.isin(*CONTROL_NAMES), F.lit(False))


def record_terms(metadata: Column) -> Column:
    """Ordered distinct (role, label, locator) of one registration's metadata VARIANT."""
    def one(role: str, value: Column, locator: str) -> Column:
        return F.array(F.struct(F.lit(role).alias("role"), F.trim(value).alias("label"),
                                F.lit(locator).alias("locator")))

    parts = [one("source_category", json_value(metadata, f"$.{k}"), f"$.{k}") for k in CATEGORY_KEYS]
    path = tx.category_path_terms(json_value(metadata, "$.category_path_raw"),
                                  F.coalesce(json_value(metadata, "$.title"), F.lit("")))
    parts.append(F.coalesce(F.transform(path, lambda t: F.struct(
        F.lit("source_category").alias("role"), t["label"].alias("label"),
        F.concat(F.lit("$.category_path_raw::"), t["locator"]).alias("locator"))), _no_terms()))
    nested = "$.source_catalog_record."
    parts += [one("source_category", json_value(metadata, nested + k), nested + k) for k in NESTED_CATEGORY_KEYS]
    words = F.transform(F.split(json_value(metadata, "$.keywords_raw"), ","), lambda x, i: F.struct(
        F.lit("keyword_token_candidate").alias("role"), F.trim(x).alias("label"),
        F.concat(F.lit("$.keywords_raw::comma_token["), i.cast("string"), F.lit("]")).alias("locator")))
    parts.append(F.coalesce(words, _no_terms()))
    parts += [one("keyword_token_candidate", json_value(metadata, nested + k), nested + k)
              for k in NESTED_KEYWORD_KEYS]
    return F.array_distinct(F.filter(F.concat(*parts), lambda t: F.coalesce(t["label"] != "", F.lit(False))))


def _no_terms() -> Column:
    return F.array().cast("array<struct<role:string,label:string,locator:string>>")


def catalog_label_items(records: DataFrame) -> DataFrame:
    """One item per label in a registration's metadata."""
    t = records.select(F.col("id").alias("record_id"), "portal_id", "evidence_id",
                       F.inline(record_terms(F.col("metadata"))))
    return _items(t, "catalog_label", label="label", locator="locator", role="role")


def documented_field_items(fields: DataFrame, records: DataFrame) -> DataFrame:
    """One item per formal column definition; the portal comes from its registration."""
    rec = records.select(F.col("id").alias("record_id"), "portal_id")
    have = set(fields.columns)
    src = fields.select("record_id", F.col("name").alias("label"), *[
        F.col(c) if c in have else F.lit(None).cast("string").alias(c)
        for c in ("name_en", "unit", "evidence_id", "ordinal", "locator", "source_url", "description",
                  "datatype", "role")])
    out = _items(dictionary_join(src, rec, ["record_id"], salts=1), "documented_field", label="label", name_en="name_en", unit="unit",
                 ordinal="ordinal", locator="locator", source_url="source_url", description="description",
                 datatype="datatype", role="role")
    return out.withColumn("is_control", is_control(F.col("role"), F.col("name_en")))


def declared_output_items(tokens: DataFrame, records: DataFrame) -> DataFrame:
    """One item per declared output token; a candidate label, not a column."""
    rec = records.select(F.col("id").alias("record_id"), "portal_id", "evidence_id", F.col("url").alias("source_url"))
    t = dictionary_join(tokens.filter("role = 'output'").select("record_id", F.col("name").alias("label"), "ordinal"),
                        rec, ["record_id"], salts=1)
    t = t.withColumn("locator", F.concat(F.lit("stored_fields:role=output;ordinal="), F.col("ordinal").cast("string")))
    t = t.withColumn("role", F.lit("declared_output_token"))
    return _items(t, "declared_output", label="label", ordinal="ordinal", locator="locator",
                  source_url="source_url", role="role")


def _items(df: DataFrame, kind: str, **have: str) -> DataFrame:
    types = {"ordinal": "int", "is_control": "boolean"}
    cols = []
    for c in ITEM_COLUMNS:
        if c == "kind":
            cols.append(F.lit(kind).alias(c))
        elif c in ("record_id", "portal_id", "evidence_id"):
            cols.append(F.col(c))
        elif c == "is_control":
            cols.append(F.lit(False).alias(c))
        elif c in have:
            cols.append(F.col(have[c]).cast(types.get(c, "string")).alias(c))
        else:
            cols.append(F.lit(None).cast(types.get(c, "string")).alias(c))
    return df.select(*cols)


def number_items(items: DataFrame) -> DataFrame:
    """Dense item ids in scan order: labels, then fields, then tokens, by record.

    The order ends in every column, so equal leading keys still spread over
    range partitions.
    """
    return dense_row_number(items, scan_order(), "id").select("id", *items.columns)


def scan_order() -> list[Column]:
    branch = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    return [branch, *[F.col(c) for c in ("record_id", "evidence_id", "ordinal", "locator", "role", "label", "name_en", "unit")]]


def item_labels(label: Column, name_en: Column) -> Column:
    """Distinct non-empty trimmed labels of an item, name first."""
    both = F.array_compact(F.array(F.nullif(F.trim(label), F.lit("")), F.nullif(F.trim(name_en), F.lit(""))))
    return F.array_distinct(both)


def match_items(items: DataFrame, aliases: DataFrame, rules: Sequence[ScopeRule] = SCOPE_RULES) -> DataFrame:
    """Add ``concept_ids``: the sorted concepts whose alias equals a label exactly.

    Catalogue labels may hit topics, fields and tokens may not; units match only
    the unit text of a formal field.  Control fields match nothing.  The alias
    table is joined once per text column as a dictionary (alias -> concepts), so
    the items themselves are neither exploded nor shuffled, and the per-item work
    is plain array concatenation inside generated code.
    """
    def ids(keep: Column) -> Column:
        return F.array_compact(F.collect_set(F.when(keep, F.col("concept_id"))))

    unit = F.col("kind") == "Unit"
    # Written once: its size is checked and it is read by three joins.
    book = materialize(aliases.groupBy("alias").agg(
        ids(~unit).alias("_any"), ids(~unit & (F.col("kind") != "Topic")).alias("_narrow"), ids(unit).alias("_unit")),
        "aliases")
    names, units = book.filter(F.size("_any") > 0).drop("_unit"), book.filter(F.size("_unit") > 0).select("alias", "_unit")
    fits = fits_broadcast(book)
    out = items
    for column in ("label", "name_en"):
        side = names.select("alias", F.col("_any").alias(f"_{column}_any"), F.col("_narrow").alias(f"_{column}_narrow"))
        out = dictionary_join(out.withColumn("alias", F.trim(column)), side, ["alias"], "left", fits=fits).drop("alias")
    out = dictionary_join(out.withColumn("alias", F.col("unit")), units, ["alias"], "left", fits=fits).drop("alias")
    none = F.array().cast("array<string>")
    is_label, is_field = F.col("kind") == "catalog_label", F.col("kind") == "documented_field"

    def hits(column: str) -> Column:
        return F.coalesce(F.when(is_label, F.col(f"_{column}_any")).otherwise(F.col(f"_{column}_narrow")), none)

    found = F.concat(hits("label"), hits("name_en"), F.coalesce(F.when(is_field, F.col("_unit")), none))
    for r in rules:
        hit = F.coalesce(F.col(r.field) == r.value, F.lit(False))
        if r.action == "exclude":
            drop = hit & ~F.coalesce(F.col("portal_id") == r.portal, F.lit(False))
            found = F.when(drop, F.array_remove(found, r.concept_id)).otherwise(found)
        else:
            add = hit & (F.col("portal_id") == r.portal) & is_field
            found = F.when(add, F.array_append(found, F.lit(r.concept_id))).otherwise(found)
    found = F.when(F.col("is_control"), none).otherwise(F.sort_array(F.array_distinct(found)))
    return out.withColumn("concept_ids", found).drop(
        "_label_any", "_label_narrow", "_name_en_any", "_name_en_narrow", "_unit")


def portal_concepts(matched: DataFrame) -> DataFrame:
    """Occurrences and distinct registrations per portal, concept and item kind."""
    return concept_counts(matched.select("portal_id", F.explode("concept_ids").alias("concept_id"), "kind", "record_id"))


def concept_counts(pairs: DataFrame) -> DataFrame:
    """``portal_concepts`` from (portal, concept, kind, record) pairs.

    Registrations are counted first per (group, record), so a concept holding a
    third of all items is reduced on the map side by record.
    """
    per_record = pairs.groupBy("portal_id", "concept_id", "kind", "record_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_record.groupBy("portal_id", "concept_id", "kind").agg(
        F.sum("_n").cast("long").alias("occurrences"), F.count("record_id").alias("record_count"))


def graph_counts(matched: DataFrame) -> DataFrame:
    """One row of totals: items by kind, mapped items and records, pairs, controls."""
    return record_totals(record_counts(matched))


def record_counts(matched: DataFrame) -> DataFrame:
    """Counts of each record: items, mapped items, pairs, control fields, items by kind."""
    is_mapped = F.size("concept_ids") > 0
    return matched.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(is_mapped).alias("mapped"),
        F.sum(F.size("concept_ids")).alias("pairs"), F.count_if("is_control").alias("controls"),
        *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS])


def record_totals(per_record: DataFrame) -> DataFrame:
    """Totals over ``record_counts``."""
    return per_record.agg(
        F.sum("items").alias("source_items"), *[F.sum(k).alias(f"items_{k}") for k in KINDS],
        F.sum("pairs").alias("lexical_mapping_occurrences"), F.sum("mapped").alias("matched_source_items"),
        (F.sum("items") - F.sum("mapped")).alias("unmapped_source_items"),
        F.count_if(F.col("mapped") > 0).alias("matched_records"), F.sum("controls").alias("control_fields"))


def term_role(kind: Column, role: Column, control: Column) -> Column:
    return (F.when(kind == "catalog_label", role).when(kind == "declared_output", F.lit("declared_output_token"))
            .when(control, F.lit("documented_control_label")).otherwise(F.lit("documented_field_label")))


def item_terms(items: DataFrame, key: str = "id") -> DataFrame:
    """(item, portal, role, label) rows: item labels and units as reported."""
    labels = F.transform(item_labels(F.col("label"), F.col("name_en")), lambda x: F.struct(
        term_role(F.col("kind"), F.col("role"), F.col("is_control")).alias("term_role"), x.alias("term")))
    unit = F.when(F.coalesce(F.trim("unit"), F.lit("")) != "", F.array(F.struct(
        F.lit("documented_unit").alias("term_role"), F.trim("unit").alias("term"))))
    both = F.concat(labels, F.coalesce(unit, F.slice(labels, 1, 0)))
    return items.select(F.col(key).alias("item_id"), "record_id", "portal_id", F.inline(both))


def term_buckets(terms: DataFrame, examples: int = 2) -> DataFrame:
    """Occurrences of each (portal, role, label) with its first examples in scan order.

    Counting and example picking are separate: counts combine on the map side and
    the ranked window is limited per task before it shuffles.
    """
    keys = ["portal_id", "term_role", "term"]
    counts = term_counts(terms)
    w = Window.partitionBy(*keys).orderBy("item_id")
    first = (terms.select(*keys, "item_id", "record_id").withColumn("_rn", F.row_number().over(w))
             .filter(F.col("_rn") <= examples))
    picked = first.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", "record_id"))), lambda x: x["record_id"]).alias("examples"))
    return shuffle_join(counts, picked, keys)


def term_counts(terms: DataFrame) -> DataFrame:
    """Occurrences of each (portal, role, label)."""
    return terms.groupBy("portal_id", "term_role", "term").agg(F.count(F.lit(1)).alias("occurrences"))


def top_terms(buckets: DataFrame, k: int = 60, role: str | None = None, q: str | None = None) -> DataFrame:
    """The k most frequent terms, ties by key; ``q`` is a literal substring."""
    out = buckets
    if role:
        out = out.filter(F.col("term_role") == role)
    if q:
        out = out.filter(tx.contains_literal("term", q))
    return out.orderBy(F.desc("occurrences"), "portal_id", "term_role", "term").limit(k)


def diverse_sample(matches: DataFrame, order: Sequence[str], per_concept: int = SAMPLE_PER_CONCEPT,
                   per_portal: int = SAMPLE_PER_PORTAL) -> DataFrame:
    """First matches of each concept, at most ``per_portal`` from any one portal.

    ``matches(concept_id, portal_id, ...)``; both ranks are limited inside each
    task before the shuffle, so a hot concept never gathers.
    """
    by_portal = Window.partitionBy("concept_id", "portal_id").orderBy(*order)
    some = matches.withColumn("_p", F.row_number().over(by_portal)).filter(F.col("_p") <= per_portal).drop("_p")
    by_concept = Window.partitionBy("concept_id").orderBy(*order)
    return some.withColumn("sample_no", F.row_number().over(by_concept)).filter(F.col("sample_no") <= per_concept)


def mapping_proposals(sample: DataFrame, concepts: DataFrame) -> DataFrame:
    """Review proposals with stable ids for sampled matches."""
    c = concepts.select(F.col("id").alias("concept_id"), F.col("kind").alias("concept_kind"), "scope_checks")
    p = dictionary_join(sample, c, ["concept_id"])
    unit = F.col("concept_kind") == "Unit"
    return p.select(
        tx.uid("mapping", "concept_id", "kind", "record_id", "evidence_id", "ordinal", "locator").alias("id"),
        "concept_id", F.when(unit, F.lit("hasUnit")).otherwise(F.lit("describesConcept")).alias("proposed_predicate"),
        F.when(F.col("kind") == "catalog_label", F.col("role")).when(unit, F.lit("literal_unit"))
        .otherwise(F.lit("exact_alias_with_source_scope")).alias("match_channel"),
        "kind", "record_id", "evidence_id", "ordinal", "locator", "label", "portal_id",
        F.lit("candidate_pending_human_review").alias("status"), F.lit(False).alias("human_approved"),
        F.col("scope_checks").alias("required_checks"))


def enrich_sample(sample: DataFrame, records: DataFrame) -> DataFrame:
    """Fetch titles and links only for sampled rows (the sample is the small side)."""
    ids = sample.select("record_id").distinct()
    wanted = records.select(F.col("id").alias("record_id"), F.col("title").alias("record_title"),
                            F.col("url").alias("record_url"), "dataset_key")
    wanted = dictionary_join(wanted, ids, ["record_id"], "left_semi")
    return sample.join(wanted, "record_id", "left")


def join_review_task(task_id: str, source: str, target: str, checks: Sequence[str], records: DataFrame) -> DataFrame:
    """A join-review task for one pair, only if both registrations exist."""
    found = records.filter(F.col("id").isin(source, target)).agg(F.count_distinct("id").alias("n"))
    return found.filter(F.col("n") == len({source, target})).select(
        F.lit(task_id).alias("id"), F.lit(source).alias("source_record_id"), F.lit(target).alias("target_record_id"),
        F.lit("joinableUnderConditions").alias("proposed_relation"),
        F.lit("candidate_pending_human_review").alias("status"), F.lit(list(checks)).alias("required_checks"),
        F.lit(False).alias("actual_join_executed"))
