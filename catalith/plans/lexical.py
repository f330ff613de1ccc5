"""Queries over source items, alias matches and searches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.functions import text as tx
from catalith.layout import dense_row_number, dictionary_join
from catalith.operators import coverage as cv
from catalith.operators import lexical as lx
from catalith.operators import search as se
from catalith.operators import shard_search as sh
from catalith.plans import model as m
from catalith.plans.registry import Tables, query
from catalith.sources import catalog as ct


@query("q01_record_terms", f"""WITH {m.ITEMS} SELECT role, label, locator, count(*) AS n FROM items
  WHERE kind = 'catalog_label' GROUP BY ALL""")
def record_terms(t: Tables):
    return lx.catalog_label_items(m.records(t)).groupBy("role", "label", "locator").agg(F.count(F.lit(1)).alias("n"))


@query("q02_alias_match", f"""WITH {m.MATCH} SELECT record_id, kind, evidence_id, CAST(ordinal AS INTEGER) AS ordinal,
  locator, label, concept_id FROM mapped""")
def alias_match(t: Tables):
    return m.graph(t).items.select("record_id", "kind", "evidence_id", "ordinal", "locator", "label",
                                   F.explode("concept_ids").alias("concept_id"))


@query("q03_portal_concepts", f"""WITH {m.MATCH} SELECT portal_id, concept_id, kind, count(*) AS occurrences,
  count(DISTINCT record_id) AS record_count FROM mapped GROUP BY ALL""")
def portal_concepts(t: Tables):
    return m.graph(t).portal_concepts


_TERMS = """, terms AS (
  SELECT record_id, portal_id, CASE WHEN kind = 'catalog_label' THEN role WHEN kind = 'declared_output'
    THEN 'declared_output_token' WHEN is_control THEN 'documented_control_label' ELSE 'documented_field_label' END AS term_role,
    term FROM (SELECT *, unnest(list_distinct([x FOR x IN [label, name_en] IF x IS NOT NULL])) AS term FROM items)
  UNION ALL SELECT record_id, portal_id, 'documented_unit', unit FROM items WHERE unit IS NOT NULL)"""


def _terms(t: Tables):
    keyed = m.items(t).withColumn("id", F.concat_ws("|", "record_id", "evidence_id", F.col("ordinal").cast("string"), "locator"))
    return lx.item_terms(keyed)


@query("q04_term_buckets", f"""WITH {m.ITEMS}, numbered AS (SELECT *, row_number() OVER (ORDER BY CASE kind WHEN 'catalog_label' THEN 1
    WHEN 'documented_field' THEN 2 ELSE 3 END, record_id, evidence_id, ordinal NULLS FIRST, locator NULLS FIRST) AS id FROM items),
  terms AS (
  SELECT id, record_id, portal_id, CASE WHEN kind = 'catalog_label' THEN role WHEN kind = 'declared_output'
    THEN 'declared_output_token' WHEN is_control THEN 'documented_control_label' ELSE 'documented_field_label' END AS term_role,
    term FROM (SELECT *, unnest(list_distinct([x FOR x IN [label, name_en] IF x IS NOT NULL])) AS term FROM numbered)
  UNION ALL SELECT id, record_id, portal_id, 'documented_unit', unit FROM numbered WHERE unit IS NOT NULL)
  SELECT portal_id, term_role, term, count(*) AS occurrences, array_to_string((list(record_id ORDER BY id))[1:2], ',') AS examples
  FROM terms GROUP BY ALL""")
def term_buckets(t: Tables):
    return m.graph(t).terms.withColumn("examples", F.array_join("examples", ","))


@query("q05_top_terms", f"""WITH {m.ITEMS}{_TERMS} SELECT portal_id, term_role, term, count(*) AS occurrences FROM terms
  GROUP BY ALL ORDER BY occurrences DESC, portal_id, term_role, term LIMIT 80""")
def top_terms(t: Tables):
    return lx.top_terms(m.graph(t).term_counts, 80)


@query("q06_diverse_sample", f"""WITH {m.MATCH}, m2 AS (SELECT *, CASE kind WHEN 'catalog_label' THEN 1
  WHEN 'documented_field' THEN 2 ELSE 3 END AS branch FROM mapped),
  a AS (SELECT *, row_number() OVER (PARTITION BY concept_id, portal_id ORDER BY branch, record_id, evidence_id, ordinal NULLS FIRST, locator NULLS FIRST) AS p FROM m2),
  b AS (SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY branch, record_id, evidence_id, ordinal NULLS FIRST, locator NULLS FIRST) AS sample_no FROM a WHERE p <= 2)
  SELECT concept_id, portal_id, record_id, evidence_id, CAST(sample_no AS INTEGER) AS sample_no FROM b WHERE sample_no <= 12""")
def diverse_sample(t: Tables):
    return _sample(t).select("concept_id", "portal_id", "record_id", "evidence_id", "sample_no")


def _sample(t: Tables):
    """The sample in scan order, which the ids follow; only ids are ranked, and the few sampled items fetched by them."""
    items = m.graph(t).items
    pairs = items.select("id", "portal_id", F.explode("concept_ids").alias("concept_id"))
    first = materialize(lx.diverse_sample(pairs, ["id"]), "sample").drop("portal_id")
    return materialize(dictionary_join(items, first, ["id"]), "sample")


@query("q52_mapping_proposals", f"""WITH {m.MATCH}, m2 AS (SELECT *, CASE kind WHEN 'catalog_label' THEN 1
  WHEN 'documented_field' THEN 2 ELSE 3 END AS branch FROM mapped),
  a AS (SELECT *, row_number() OVER (PARTITION BY concept_id, portal_id ORDER BY branch, record_id, evidence_id, ordinal NULLS FIRST, locator NULLS FIRST) AS p FROM m2),
  b AS (SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY branch, record_id, evidence_id, ordinal NULLS FIRST, locator NULLS FIRST) AS s FROM a WHERE p <= 2)
  SELECT 'mapping-' || substr(sha256(concat_ws(chr(31), concept_id, kind, record_id, b.evidence_id,
      coalesce(CAST(ordinal AS VARCHAR), 'None'), coalesce(locator, 'None'))), 1, 20) AS id, concept_id,
    CASE WHEN concept_id LIKE 'unit:%' THEN 'hasUnit' ELSE 'describesConcept' END AS proposed_predicate,
    CASE WHEN kind = 'catalog_label' THEN role WHEN concept_id LIKE 'unit:%' THEN 'literal_unit'
      ELSE 'exact_alias_with_source_scope' END AS match_channel, p_name AS record_title,
    'candidate_pending_human_review' AS status
  FROM b JOIN rec USING (record_id) WHERE s <= 12 AND concept_id <> 'measure:open'""")
def mapping_proposals(t: Tables):
    v = m.vocabulary(t)
    p = lx.enrich_sample(lx.mapping_proposals(_sample(t), v.concepts), m.records(t))
    return p.select("id", "concept_id", "proposed_predicate", "match_channel", "record_title", "status")


@query("q53_graph_counts", f"""WITH {m.MATCH}, per AS (SELECT iid, count(*) AS n FROM hits GROUP BY iid)
  SELECT count(*) AS source_items, count(*) FILTER (kind = 'catalog_label') AS items_catalog_label,
    count(*) FILTER (kind = 'documented_field') AS items_documented_field,
    count(*) FILTER (kind = 'declared_output') AS items_declared_output,
    CAST(sum(coalesce(n, 0)) AS BIGINT) AS lexical_mapping_occurrences, count(n) AS matched_source_items,
    count(*) - count(n) AS unmapped_source_items, count(DISTINCT CASE WHEN n IS NOT NULL THEN record_id END) AS matched_records,
    count(*) FILTER (is_control) AS control_fields FROM ranked_items LEFT JOIN per USING (iid)""")
def graph_counts(t: Tables):
    return m.graph(t).counts()


@query("q54_item_ids", f"""WITH {m.ITEMS} SELECT row_number() OVER (ORDER BY CASE kind WHEN 'catalog_label' THEN 1
    WHEN 'documented_field' THEN 2 ELSE 3 END, record_id NULLS FIRST, evidence_id NULLS FIRST, ordinal NULLS FIRST,
    locator NULLS FIRST) AS id, record_id, evidence_id, CAST(ordinal AS INTEGER) AS ordinal, locator FROM items""")
def item_ids(t: Tables):
    return m.graph(t).items.select("id", "record_id", "evidence_id", "ordinal", "locator")


_ORD = """ORDER BY portal_id, record_id, kind, evidence_id, ordinal NULLS FIRST, locator NULLS FIRST"""


def _keyed(t: Tables):
    """Matched items under a textual key instead of a numbered id."""
    return m.graph(t).items.withColumn("id", F.concat_ws("|", "kind", "record_id", "evidence_id", F.coalesce(
        F.lpad(F.col("ordinal").cast("string"), 6, "0"), F.lit("")), F.coalesce("locator", F.lit(""))))


_KEYED = m.MATCH + """, keyed AS (SELECT *, kind || '|' || record_id || '|' || evidence_id || '|' ||
  coalesce(lpad(CAST(ordinal AS VARCHAR), 6, '0'), '') || '|' || coalesce(locator, '') AS id FROM ranked_items),
  concepts AS (SELECT iid, string_agg(concept_id, ',' ORDER BY concept_id) AS concept_ids FROM hits GROUP BY iid)"""


@query("q08_search_items", f"""WITH {_KEYED} SELECT id, label, name_en, concept_ids,
  'candidate_pending_human_review' AS semantic_status FROM keyed JOIN concepts USING (iid)
  WHERE kind = 'catalog_label' AND contains(translate(label, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'bo')""")
def search_items(t: Tables):
    r = se.search_items(_keyed(t), basis="catalog_label", q="BO", mode="mapped").matches
    return r.select("id", "label", "name_en", F.array_join("concept_ids", ",").alias("concept_ids"), "semantic_status")


@query("q09_page", f"""WITH {_KEYED} SELECT id, label, coalesce(concept_ids, '') AS concept_ids FROM keyed
  LEFT JOIN concepts USING (iid) WHERE portal_id = 'Brand#3' ORDER BY id LIMIT 24 OFFSET 24""")
def search_page(t: Tables):
    v = m.vocabulary(t)
    r = se.search_items(_keyed(t), portal="Brand#3", mode="all", number=2,
                        portals=t.part.select(F.col("p_brand").alias("portal_id")), concepts=v.concepts).rows
    return r.select("id", "label", F.array_join("concept_ids", ",").alias("concept_ids"))


_NUMBERED = m.MATCH + """, numbered AS (SELECT *, row_number() OVER (ORDER BY CASE kind WHEN 'catalog_label' THEN 1
    WHEN 'documented_field' THEN 2 ELSE 3 END, record_id, evidence_id, ordinal NULLS FIRST, locator NULLS FIRST) AS id FROM ranked_items),
  concepts AS (SELECT iid, string_agg(concept_id, ',' ORDER BY concept_id) AS concept_ids FROM hits GROUP BY iid),
  full_items AS (SELECT n.*, coalesce(concept_ids, '') AS concept_ids FROM numbered n LEFT JOIN concepts USING (iid))"""
#: Searches by name: the filters and the page, and the same filters in SQL.
_SHARD_SEARCHES = {
    "deep page": ({"mode": "all", "number": 150}, "true"),
    "deep mapped page": ({"number": 140}, "concept_ids <> ''"),
    "portal and kind": ({"portal": "Brand#3", "basis": "catalog_label", "mode": "all", "number": 3},
                        "portal_id = 'Brand#3' AND kind = 'catalog_label'"),
    "concept in a portal": ({"concept": "entitytype:bolt", "portal": "Brand#2", "number": 2},
                            "portal_id = 'Brand#2' AND iid IN (SELECT iid FROM hits WHERE concept_id = 'entitytype:bolt')"),
    "text": ({"q": "BO", "number": 5}, "concept_ids <> '' AND (contains(lower(label), 'bo') OR contains(lower(coalesce(name_en, '')), 'bo'))"),
    "record": ({"record": "part-7", "mode": "all"}, "record_id = 'part-7'"),
    "record and concept": ({"record": "part-7", "concept": "measure:r"}, "record_id = 'part-7' AND iid IN (SELECT iid FROM hits WHERE concept_id = 'measure:r')"),
    "past the end": ({"portal": "Brand#3", "number": 1000000}, "false"),
}
_SHARD_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS search, id, label, record_id, concept_ids FROM (SELECT *, row_number() OVER (ORDER BY id) AS place FROM full_items WHERE {where}) "
    f"WHERE place BETWEEN {24 * f.get('number', 1) - 23} AND {24 * f.get('number', 1)}" for name, (f, where) in _SHARD_SEARCHES.items())


@query("q181_shard_search", f"WITH {_NUMBERED} {_SHARD_SQL}")
def shard_search(t: Tables):
    found = [sh.search_shards(m.shards(t), **f).rows.select(F.lit(name).alias("search"), "id", "label", "record_id",
                                                            F.array_join("concept_ids", ",").alias("concept_ids"))
             for name, (f, _) in _SHARD_SEARCHES.items()]
    return reduce(lambda a, b: a.unionAll(b), found)


@query("q55_search_concept", f"""WITH {_KEYED}, k AS (SELECT count(*) AS total FROM keyed JOIN hits USING (iid)
  WHERE concept_id = 'entitytype:bolt') SELECT total, CAST(ceil(total / 24.0) AS BIGINT) AS pages FROM k""")
def search_concept(t: Tables):
    return se.search_items(_keyed(t), concept="entitytype:bolt").totals()


@query("q56_literal_search", f"""WITH {_KEYED} SELECT count(*) AS total FROM keyed
  WHERE contains(lower(label), '%') OR contains(lower(name_en), '%') OR contains(label, ''' or 1=1 --')""")
def literal_search(t: Tables):
    k = _keyed(t)
    a = se.search_items(k, q="%", mode="all").matches.select("id")
    b = se.search_items(k, q="' OR 1=1 --", mode="all").matches.select("id")
    return a.unionAll(b).agg(F.count(F.lit(1)).alias("total"))


@query("q10_registrations_counts", """SELECT 'order-' || o_orderkey AS id, o_orderpriority AS title, count(l_orderkey) AS source_items
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE contains(lower(o_orderpriority), 'high') GROUP BY ALL""")
def registrations_counts(t: Tables):
    rec = t.orders.select(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("id"),
                          F.lit("orders").alias("portal_id"), F.col("o_orderpriority").alias("title"))
    it = t.lineitem.select(F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("record_id"))
    return se.item_counts(se.search_registrations(rec, it, q="HIGH").matches, it).select("id", "title", "source_items")


@query("q57_registrations_page", """SELECT 'order-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS id, count(l_orderkey) AS source_items
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL ORDER BY id LIMIT 24 OFFSET 48""")
def registrations_page(t: Tables):
    pad = lambda c: F.concat(F.lit("order-"), F.lpad(F.col(c).cast("string"), 12, "0"))
    rec = t.orders.select(pad("o_orderkey").alias("id"), F.lit("orders").alias("portal_id"), F.lit("").alias("title"))
    it = t.lineitem.select(pad("l_orderkey").alias("record_id"))
    return se.search_registrations(rec, it, number=3).rows.select("id", "source_items")


@query("q11_field_search_union", f"""WITH {m.REC}, {m.DOC} SELECT record_id FROM rec WHERE w0 LIKE '%re%' OR w1 LIKE '%re%'
  UNION SELECT record_id FROM doc WHERE lower(name) LIKE '%re%' OR lower(name_en) LIKE '%re%'""")
def field_search_union(t: Tables):
    rec = m.records(t)
    return se.records_with_field(ct.declared_fields(rec).filter("role = 'output'"), m.documented(t), "re")


@query("q58_search_catalog", f"""WITH {m.REC}, {m.DOC} SELECT record_id AS id, p_name AS title,
  (SELECT count(*) FROM doc d WHERE d.record_id = rec.record_id) AS documented_columns FROM rec
  WHERE 'provider ' || p_size LIKE '%provider 1_%' AND p_name LIKE '%b_lt%' AND record_id IN (SELECT record_id FROM doc)
  ORDER BY portal_id, id LIMIT 25""")
def search_catalog(t: Tables):
    rec = m.records(t)
    r = se.search_catalog(rec, ct.declared_fields(rec), m.documented(t), provider="Provider 1_", q="b_lt",
                          documented_only=True, number=0).rows
    return r.select("id", "title", "documented_columns")


@query("q12_documented_anti", """SELECT CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'with' ELSE 'without' END
  AS documented, count(*) AS n FROM orders GROUP BY 1""")
def documented_anti(t: Tables):
    rec = t.orders.select(F.col("o_orderkey").alias("id"))
    doc = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("record_id"))
    yes, no = cv.documented_split(rec, doc)
    return (yes.agg(F.count(F.lit(1)).alias("n")).select(F.lit("with").alias("documented"), "n")
            .unionAll(no.agg(F.count(F.lit(1)).alias("n")).select(F.lit("without").alias("documented"), "n")))


@query("q59_declared_fields", f"""WITH {m.REC} SELECT record_id, u.role AS role, CAST(u.pos AS INTEGER) AS ordinal, u.label AS name FROM (
  SELECT record_id, unnest([{{'role': 'output', 'pos': 1, 'label': w0}}, {{'role': 'output', 'pos': 2, 'label': w1}},
    {{'role': 'request', 'pos': 1, 'label': p_type}}]) AS u FROM rec)""")
def declared_fields(t: Tables):
    return ct.declared_fields(m.records(t)).drop("status")


@query("q60_normalize_catalog", """SELECT 'part-' || p_partkey AS id, p_brand AS portal_id, p_name || '/' || p_size AS dataset_key,
    p_type AS kind, 'org-' || p_size AS provider_id, p_type AS category FROM part
  UNION ALL SELECT 'supplier-' || s_suppkey, 'nation-' || s_nationkey, s_name, NULL, NULL, NULL FROM supplier""")
def normalize_catalog(t: Tables):
    sup = ct.normalize_catalog(t.supplier, {
        "id": F.concat(F.lit("supplier-"), F.col("s_suppkey").cast("string")), "dataset_key": F.col("s_name"),
        "portal_id": F.concat(F.lit("nation-"), F.col("s_nationkey").cast("string"))})
    both = ct.union_catalogs(m.records(t), sup)
    return both.select("id", "portal_id", "dataset_key", "kind", "provider_id",
                       F.try_variant_get("metadata", "$.source_category", "string").alias("category"))


@query("q61_item_detail", f"""WITH {_KEYED} SELECT k.id, k.label, r.p_name AS title, c.concept_ids, k.evidence_id
  FROM keyed k JOIN rec r USING (record_id) LEFT JOIN concepts c USING (iid) WHERE k.kind = 'declared_output'""")
def item_detail(t: Tables):
    mine = _keyed(t).filter("kind = 'declared_output'")
    rec = m.records(t).select(F.col("id").alias("record_id"), "title")
    out = mine.join(rec, "record_id", "left")
    return out.select("id", "label", "title", F.nullif(F.array_join("concept_ids", ","), F.lit("")).alias("concept_ids"), "evidence_id")


@query("q62_tokens", """SELECT p_partkey, CAST(u.i AS INTEGER) AS ordinal, trim(u.x) AS label FROM (
  SELECT p_partkey, unnest(list_transform(string_split(p_name || ', ,' || p_type || ' ,', ','), lambda x, i: {'x': x, 'i': i})) AS u FROM part)
  WHERE trim(u.x) <> ''""")
def tokens(t: Tables):
    return t.part.select("p_partkey", F.inline(tx.tokens(F.concat("p_name", F.lit(", ,"), "p_type", F.lit(" ,")))))


@query("q63_row_numbers", """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_totalprice, o_orderkey) AS row_no FROM orders""")
def row_numbers(t: Tables):
    return dense_row_number(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"),
                            ["o_orderpriority", "o_totalprice", "o_orderkey"]).select("o_orderkey", "row_no")


@query("q178_search_terms", f"""WITH {m.ITEMS}{_TERMS} SELECT portal_id, term_role, term, count(*) AS occurrences FROM terms
  WHERE term_role = 'keyword_token_candidate' AND contains(lower(term), 'ol') GROUP BY ALL ORDER BY occurrences DESC, portal_id, term_role, term LIMIT 80""")
def search_terms(t: Tables):
    counts = _terms(t).groupBy("portal_id", "term_role", "term").agg(F.count(F.lit(1)).alias("occurrences"))
    return lx.top_terms(counts, 80, role="keyword_token_candidate", q="OL")


@query("q179_record_detail", f"""WITH {m.DOC} SELECT 'definition' AS part, evidence_id || ':' || ordinal AS entry FROM doc WHERE record_id = 'part-1'
  UNION ALL SELECT 'token', 'output:1' UNION ALL SELECT 'token', 'output:2' UNION ALL SELECT 'token', 'request:1'
  UNION ALL SELECT 'record', p_name FROM part WHERE p_partkey = 1 UNION ALL SELECT DISTINCT 'document', evidence_id FROM doc WHERE record_id = 'part-1'""")
def record_detail(t: Tables):
    rec, doc = m.records(t), m.documented(t)
    sources = doc.select("record_id", F.col("evidence_id").alias("path"))
    one, definitions, tokens, documents = se.record_detail("part-1", rec, doc, ct.declared_fields(rec), sources)

    def part(name, df, entry):
        return df.select(F.lit(name).alias("part"), entry.alias("entry"))

    return (part("definition", definitions, F.concat_ws(":", "evidence_id", "ordinal")).unionAll(part("token", tokens, F.concat_ws(":", "role", "ordinal")))
            .unionAll(part("record", one, F.col("title"))).unionAll(part("document", documents, F.col("path"))))


@query("q180_join_review_task", """SELECT 'join:1' AS id, 'part-1' AS source_record_id, 'part-2' AS target_record_id, 'joinableUnderConditions' AS proposed_relation, 'same period|same area' AS checks
  FROM part WHERE p_partkey IN (1, 2) HAVING count(*) = 2""")
def join_review_task(t: Tables):
    task = lx.join_review_task("join:1", "part-1", "part-2", ["same period", "same area"], m.records(t))
    return task.select("id", "source_record_id", "target_record_id", "proposed_relation", F.array_join("required_checks", "|").alias("checks"))
