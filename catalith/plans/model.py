"""The given tables in catalogue roles, in Spark and in SQL.

portal = brand, registration = part, formal column = line item, evidence =
order; the vocabulary is derived from the words the tables use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.operators import graph_store as gs
from catalith.operators import lexical as lx
from catalith.operators import shard_search as sh
from catalith.plans.registry import Tables
from catalith.sources import catalog as ct
from catalith.sources.vocabulary import Vocabulary, concept_vocabulary

RULES = (lx.ScopeRule("exclude", "Brand#1", "label", "small", "dimension:small"),
         lx.ScopeRule("include", "Brand#2", "name_en", "O", "measure:open"))


def records(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    words = F.replace("p_name", F.lit(" "), F.lit(","))
    raw = t.spread("part").select(
        "*", F.lit("catalog > ").alias("_root"), words.alias("keywords"),
        F.concat(F.lit("catalog > "), "p_type", F.lit(" > "), "p_name").alias("path"),
        F.struct(F.col("p_type").alias("topCateNm"), F.split("p_name", " ")[0].alias("kwrd_one")).alias("nested"))
    return ct.normalize_catalog(raw, {
        "id": F.concat(F.lit("part-"), key), "portal_id": F.col("p_brand"),
        "dataset_key": F.concat_ws("/", "p_name", F.col("p_size").cast("string")), "title": F.col("p_name"),
        "provider_id": F.concat(F.lit("org-"), F.col("p_size").cast("string")),
        "provider_name": F.concat(F.lit("Provider "), F.col("p_size").cast("string")), "kind": F.col("p_type"),
        "url": F.concat(F.lit("https://parts.example.org/item/"), key, F.lit("?brand="), "p_brand"),
        "evidence_id": F.concat(F.lit("ev-"), key), "locator": F.concat(F.lit("part:"), key),
        "output_raw": words, "request_raw": F.col("p_type"), "schema_status": F.lit("declared_labels_only"),
    }, keep={"source_category": "p_type", "category_path_raw": "path", "keywords_raw": "keywords",
             "source_catalog_record": "nested"})


def documented(t: Tables) -> DataFrame:
    return t.spread("lineitem").select(
        F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("record_id"),
        F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("evidence_id"),
        F.col("l_linenumber").alias("ordinal"), F.col("l_returnflag").alias("name"),
        F.col("l_linestatus").alias("name_en"), F.when(F.col("l_discount") > 0, F.lit("pct")).alias("unit"),
        F.when(F.col("l_tax") == 0, F.lit("response_control")).otherwise(F.lit("documented_column")).alias("role"))


def vocabulary(t: Tables) -> Vocabulary:
    """Concepts for the words in use: one pass per table, then a handful of rows."""
    def pair(kind: str, label) -> object:
        return F.struct(F.lit(kind).alias("kind"), label.alias("label"))

    words = F.split("p_name", " ")
    parts = t.part.select("p_type", words[0].alias("w0"), words[1].alias("w1")).distinct().select(F.inline(F.array(
        pair("Topic", F.col("p_type")), pair("Dimension", F.col("w0")), pair("EntityType", F.col("w1")))))
    lines = t.lineitem.select("l_returnflag", "l_linestatus", F.when(F.col("l_discount") > 0, F.lit("pct")).alias("unit"))
    lines = lines.distinct().select(F.inline(F.array(
        pair("Measure", F.col("l_returnflag")), pair("IdentifierScheme", F.col("l_linestatus")), pair("Unit", F.col("unit")))))
    rows = parts.unionAll(lines).filter("label is not null").distinct()
    return concept_vocabulary(rows.select(
        "kind", F.lower("label").alias("slug"), "label", F.lit(None).cast("string").alias("topic"),
        F.col("label").alias("aliases"), F.lit("scope·unit").alias("scope_checks")))


def items(t: Tables) -> DataFrame:
    rec = records(t)
    return (lx.catalog_label_items(rec).unionByName(lx.documented_field_items(documented(t), rec))
            .unionByName(lx.declared_output_items(ct.declared_fields(rec), rec)))


def matched(t: Tables) -> DataFrame:
    return lx.match_items(items(t), vocabulary(t).aliases, RULES)


_BUILDS: dict[tuple, gs.GraphStore] = {}


def graph(t: Tables) -> gs.GraphStore:
    """The stored graph over the tables as they are now: built by the first query that asks, read by the others."""
    key = (t.spark.sparkContext.applicationId, t.version("part"), t.version("lineitem"))
    if key not in _BUILDS:
        _BUILDS[key] = gs.build(items(t), vocabulary(t).aliases, RULES)
    return _BUILDS[key]


_SHARDS: dict[str, sh.Shards] = {}


def shards(t: Tables) -> sh.Shards:
    """The stored graph's items published in shards of 20,000 ids, once a build."""
    store = graph(t)
    if store.path not in _SHARDS:
        _SHARDS[store.path] = sh.publish(store.items, f"{store.path}/shards", 20_000)
    return _SHARDS[store.path]


REC = """rec AS (SELECT 'part-' || p_partkey AS record_id, p_brand AS portal_id, p_name, p_type, p_size,
  split_part(p_name, ' ', 1) AS w0, split_part(p_name, ' ', 2) AS w1, 'ev-' || p_partkey AS evidence_id,
  'https://parts.example.org/item/' || p_partkey || '?brand=' || p_brand AS url FROM part)"""

DOC = """doc AS (SELECT 'part-' || l_partkey AS record_id, 'order-' || l_orderkey AS evidence_id,
  l_linenumber AS ordinal, l_returnflag AS name, l_linestatus AS name_en,
  CASE WHEN l_discount > 0 THEN 'pct' END AS unit,
  CASE WHEN l_tax = 0 THEN 'response_control' ELSE 'documented_column' END AS role FROM lineitem)"""

ITEMS = REC + ", " + DOC + """, items AS (
  SELECT record_id, portal_id, 'catalog_label' AS kind, u.label AS label, NULL AS name_en, NULL AS unit,
    evidence_id, NULL AS ordinal, u.locator AS locator, u.role AS role, false AS is_control FROM (
    SELECT record_id, portal_id, evidence_id, unnest([
      {'role': 'source_category', 'label': p_type, 'locator': '$.source_category'},
      {'role': 'source_category', 'label': p_type, 'locator': '$.category_path_raw::segment[1]'},
      {'role': 'source_category', 'label': p_type, 'locator': '$.source_catalog_record.topCateNm'},
      {'role': 'keyword_token_candidate', 'label': w0, 'locator': '$.keywords_raw::comma_token[0]'},
      {'role': 'keyword_token_candidate', 'label': w1, 'locator': '$.keywords_raw::comma_token[1]'},
      {'role': 'keyword_token_candidate', 'label': w0, 'locator': '$.source_catalog_record.kwrd_one'}]) AS u FROM rec)
  UNION ALL
  SELECT d.record_id, r.portal_id, 'documented_field', d.name, d.name_en, d.unit, d.evidence_id, d.ordinal, NULL,
    d.role, d.role = 'response_control' FROM doc d JOIN rec r USING (record_id)
  UNION ALL
  SELECT record_id, portal_id, 'declared_output', u.label, NULL, NULL, evidence_id, u.pos,
    'stored_fields:role=output;ordinal=' || u.pos, 'declared_output_token', false FROM (
    SELECT record_id, portal_id, evidence_id, unnest([{'label': w0, 'pos': 1}, {'label': w1, 'pos': 2}]) AS u FROM rec))"""

VOCAB = """alias AS (
  SELECT DISTINCT 'topic:' || lower(p_type) AS concept_id, 'Topic' AS ckind, p_type AS alias FROM part
  UNION SELECT 'dimension:' || w0, 'Dimension', w0 FROM rec
  UNION SELECT 'entitytype:' || w1, 'EntityType', w1 FROM rec
  UNION SELECT 'measure:' || lower(l_returnflag), 'Measure', l_returnflag FROM lineitem
  UNION SELECT 'identifierscheme:' || lower(l_linestatus), 'IdentifierScheme', l_linestatus FROM lineitem
  UNION SELECT 'unit:pct', 'Unit', unit FROM doc WHERE unit IS NOT NULL)"""

MATCH = ITEMS + ", " + VOCAB + """, ranked_items AS (SELECT *, row_number() OVER () AS iid FROM items),
  hits AS (
  SELECT DISTINCT i.iid, a.concept_id FROM ranked_items i JOIN alias a ON a.alias IN (i.label, i.name_en)
    WHERE NOT i.is_control AND a.ckind <> 'Unit' AND (i.kind = 'catalog_label' OR a.ckind <> 'Topic')
      AND NOT (a.concept_id = 'dimension:small' AND i.label = 'small' AND i.portal_id <> 'Brand#1')
  UNION SELECT i.iid, a.concept_id FROM ranked_items i JOIN alias a ON a.alias = i.unit
    WHERE NOT i.is_control AND a.ckind = 'Unit' AND i.kind = 'documented_field'
  UNION SELECT i.iid, 'measure:open' FROM ranked_items i
    WHERE NOT i.is_control AND i.kind = 'documented_field' AND i.portal_id = 'Brand#2' AND i.name_en = 'O'),
  mapped AS (SELECT i.*, h.concept_id FROM ranked_items i JOIN hits h USING (iid))"""
