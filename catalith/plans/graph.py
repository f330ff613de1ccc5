"""Queries over the discovery graph, closures, claims and triples."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.operators import coverage as cv
from catalith.operators import expand as ex
from catalith.operators import reconcile as rc
from catalith.plans import model as m
from catalith.plans.registry import Tables, query
from catalith.sinks import triples as tr


def _txt(c: str):
    return F.col(c).cast("string")


def discovery_nodes(t: Tables):
    none = F.array().cast("array<string>")

    def rows(df, kind, prefix, key, gap=F.lit(False), url=F.lit(None).cast("string")):
        return df.select(F.concat(F.lit(prefix), _txt(key)).alias("id"), F.lit(kind).alias("type"), gap.alias("data_gap"),
                         url.alias("source_url"), none.alias("limitations"))

    return (rows(t.region, "query", "q-", "r_regionkey").unionAll(rows(t.region, "concept", "c-", "r_regionkey"))
            .unionAll(rows(t.nation, "indicator", "i-", "n_nationkey", F.col("n_name").endswith("7")))
            .unionAll(rows(t.supplier, "dataset", "d-", "s_suppkey", url=F.concat(F.lit("https://s/"), _txt("s_suppkey"))))
            .unionAll(rows(t.nation, "provider", "p-", "n_nationkey")))


def discovery_edges(t: Tables):
    def key(prefix, c):
        return F.concat(F.lit(prefix), _txt(c))

    def edge(df, a, p, b, status, cost, priority, role):
        return ex.relation_rows(df, a, F.lit(p), b, status, F.array(F.concat(F.lit("ev-"), a)), cost, priority, role)

    rich = F.when(F.col("s_acctbal") > 0, F.lit("documented")).otherwise(F.lit("candidate"))
    doc = F.lit("documented")
    return (edge(t.region, key("q-", "r_regionkey"), "interpretedAs", key("c-", "r_regionkey"), F.lit("curated"), 1, 0, "query_interpretation")
            .unionAll(edge(t.nation, key("c-", "n_regionkey"), "hasIndicator", key("i-", "n_nationkey"), F.lit("curated"), 0, 5, "indicator_definition"))
            .unionAll(edge(t.supplier, key("i-", "s_nationkey"), "availableFrom", key("d-", "s_suppkey"), rich, 0, 8, "metadata_mapping"))
            .unionAll(edge(t.supplier, key("d-", "s_suppkey"), "providedBy", key("p-", "s_nationkey"), doc, 0, 5, "source_provenance")))


_RID = "'r-' || substr(sha256({0} || '|{1}|' || {2}), 1, 12)"
_GRAPH = f"""e1 AS (SELECT r_regionkey AS r, {_RID.format("'q-' || r_regionkey", "interpretedAs", "'c-' || r_regionkey")} AS e1 FROM region),
  e2 AS (SELECT n_regionkey AS r, n_nationkey AS n, {_RID.format("'c-' || n_regionkey", "hasIndicator", "'i-' || n_nationkey")} AS e2 FROM nation),
  e3 AS (SELECT r, n, s_suppkey AS s, s_acctbal, e1, e2, {_RID.format("'i-' || s_nationkey", "availableFrom", "'d-' || s_suppkey")} AS e3
    FROM supplier JOIN e2 ON n = s_nationkey JOIN e1 USING (r)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY e2, e3) AS pos FROM e3),
  tops AS (SELECT r, (SELECT count(*) FROM e2 WHERE e2.r = a.r) AS n_i, count(*) AS n_s FROM e3 a GROUP BY r),
  room AS (SELECT *, least(n_s, 199 - n_i) AS seen FROM tops)"""


@query("q29_bounded_expand", f"""WITH {_GRAPH}, took AS (SELECT r, count(*) AS d, count(DISTINCT n) AS p FROM ranked JOIN room USING (r)
    WHERE pos <= least(10, seen) GROUP BY r)
  SELECT 'q-' || r AS run_id, CAST(CASE WHEN seen < n_s THEN 2 + n_i + d ELSE 2 + n_i + d + p END AS INTEGER) AS nodes,
    CAST(CASE WHEN seen < n_s THEN 1 + n_i + d ELSE 1 + n_i + 2 * d END AS INTEGER) AS edges, d AS datasets,
    CASE WHEN seen < n_s THEN 200 ELSE 1 + n_i + n_s + d END AS scanned_edges,
    CASE WHEN seen < n_s THEN 'max_datasets,max_scanned_edges' WHEN n_s > 10 THEN 'max_datasets' ELSE '' END AS stops
  FROM room JOIN took USING (r)""")
def bounded_expand(t: Tables):
    nodes, edges = discovery_nodes(t), discovery_edges(t)
    s = ex.expansion_summary(ex.bounded_expand(nodes, edges), nodes)
    return s.select("run_id", "nodes", "edges", "datasets", "scanned_edges", F.array_join("stops", ",").alias("stops"))


@query("q30_recommend", f"""WITH {_GRAPH} SELECT 'q-' || r AS query_id, 'd-' || s AS dataset_id, e1 || ',' || e2 || ',' || e3 AS path,
  'direct_measure_path' AS reason_kind, s_acctbal <= 0 AS mapping_has_candidate,
  list_aggregate(list_sort(['ev-q-' || r, 'ev-c-' || r, 'ev-i-' || n]), 'string_agg', ',') AS evidence_ids, false AS join_allowed
  FROM ranked JOIN room USING (r) WHERE pos <= least(10, seen)""")
def recommend(t: Tables):
    nodes, edges = discovery_nodes(t), discovery_edges(t)
    r = ex.recommend(ex.bounded_expand(nodes, edges), nodes, edges)
    return r.select("query_id", "dataset_id", F.array_join("path", ",").alias("path"), "reason_kind", "mapping_has_candidate",
                    F.array_join("evidence_ids", ",").alias("evidence_ids"), "join_allowed")


@query("q98_sweep", f"""WITH {_GRAPH}, grid AS (SELECT unnest([1, 2]) AS depth), caps AS (SELECT unnest([1, 2, 3, 4, 5, 10]) AS cap)
  SELECT 'q-' || r || '/' || depth || '/' || cap AS run_id, CAST(least(cap, seen) AS BIGINT) AS datasets FROM room, grid, caps""")
def sweep(t: Tables):
    out = ex.sweep(discovery_nodes(t), discovery_edges(t), (1, 2), (1, 2, 3, 4, 5, 10))
    return out.select("run_id", "datasets")


@query("q99_unresolved_indicators", f"""WITH {_GRAPH} SELECT 'q-' || n_regionkey AS run_id, 'i-' || n_nationkey AS node FROM nation WHERE n_name LIKE '%7'""")
def unresolved_indicators(t: Tables):
    nodes = discovery_nodes(t)
    s = ex.expansion_summary(ex.bounded_expand(nodes, discovery_edges(t)), nodes)
    return s.select("run_id", F.explode("unresolved_indicators").alias("node"))


@query("q31_closure", """WITH RECURSIVE pair AS (SELECT 'nation-' || n_nationkey AS c, 'region-' || n_regionkey AS p FROM nation
    UNION ALL SELECT 'customer-' || c_custkey, 'nation-' || c_nationkey FROM customer
    UNION ALL SELECT 'region-' || r_regionkey, 'world' FROM region),
  reach(node, ancestor, hops) AS (SELECT c, c, 0 FROM pair UNION ALL SELECT node, p, hops + 1 FROM reach JOIN pair ON c = ancestor)
  SELECT node, ancestor, CAST(hops AS INTEGER) AS hops FROM reach""")
def closure(t: Tables):
    def pair(df, a, ka, b, kb):
        return df.select(F.concat(F.lit(a), _txt(ka)).alias("c"), F.concat(F.lit(b), _txt(kb)).alias("p"))

    pairs = (pair(t.nation, "nation-", "n_nationkey", "region-", "n_regionkey")
             .unionAll(pair(t.customer, "customer-", "c_custkey", "nation-", "c_nationkey"))
             .unionAll(t.region.select(F.concat(F.lit("region-"), _txt("r_regionkey")), F.lit("world"))))
    return ex.closure(pairs, "c", "p")


def claims(t: Tables):
    located = t.supplier.select(
        F.concat(F.lit("claim-"), _txt("s_suppkey")).alias("id"), F.col("s_name").alias("s"), F.lit("locatedIn").alias("p"),
        F.concat(F.lit("NATION_"), _txt("s_nationkey")).alias("o"),
        F.when(F.col("s_acctbal") > 0, F.lit("documented")).otherwise(F.lit("candidate")).alias("status"),
        F.concat(F.lit("ev-"), _txt("s_suppkey")).alias("evidence_id"))
    part_of = t.nation.select(
        F.concat(F.lit("claim-n"), _txt("n_nationkey")).alias("id"), F.col("n_name").alias("s"), F.lit("partOf").alias("p"),
        F.concat(F.lit("REGION_"), _txt("n_regionkey")).alias("o"), F.lit("documented").alias("status"), F.lit("ev-n").alias("evidence_id"))
    return located.unionAll(part_of)


_CLAIMS = """claim AS (SELECT 'claim-' || s_suppkey AS id, s_name AS s, 'locatedIn' AS p, 'NATION_' || s_nationkey AS o,
    CASE WHEN s_acctbal > 0 THEN 'documented' ELSE 'candidate' END AS status, 'ev-' || s_suppkey AS evidence_id FROM supplier
  UNION ALL SELECT 'claim-n' || n_nationkey, n_name, 'partOf', 'REGION_' || n_regionkey, 'documented', 'ev-n' FROM nation)"""


@query("q32_claims_to_triples", f"""WITH {_CLAIMS} SELECT u.s AS s, u.p AS p, u.o AS o FROM (SELECT unnest([
    {{'s': id, 'p': 'rdf:type', 'o': 'RelationshipClaim'}}, {{'s': id, 'p': 'rdf:subject', 'o': s}}, {{'s': id, 'p': 'rdf:predicate', 'o': p}},
    {{'s': id, 'p': 'rdf:object', 'o': o}}, {{'s': id, 'p': 'claimStatus', 'o': status}}, {{'s': id, 'p': 'evidence', 'o': evidence_id}}]) AS u FROM claim)
  UNION ALL SELECT DISTINCT s, p, o FROM claim WHERE status = 'documented'""")
def claims_to_triples(t: Tables):
    return tr.claims_to_triples(claims(t))


@query("q33_no_leak", f"""WITH {_CLAIMS}, fact AS (SELECT s_name AS s, 'locatedIn' AS p, 'NATION_' || s_nationkey AS o FROM supplier WHERE s_acctbal BETWEEN -500 AND 5000)
  SELECT s, p, o, 'candidate_published' AS problem FROM claim JOIN fact USING (s, p, o) WHERE status <> 'documented'
  UNION ALL SELECT s, p, o, 'documented_missing' FROM claim ANTI JOIN fact USING (s, p, o) WHERE status = 'documented'""")
def no_leak(t: Tables):
    facts = t.supplier.filter(F.col("s_acctbal").between(-500, 5000)).select(
        F.col("s_name").alias("s"), F.lit("locatedIn").alias("p"), F.concat(F.lit("NATION_"), _txt("s_nationkey")).alias("o"))
    return rc.leak_check(claims(t), facts, ("documented",))


@query("q100_ntriples", f"""WITH {_CLAIMS} SELECT '<https://x/' || s || '> <https://x/' || p || '> "' || o || '" .' AS line FROM (SELECT DISTINCT s, p, o FROM claim WHERE status = 'documented')""".replace("|| s ||", "|| replace(s, '#', '%23') ||"))
def ntriples(t: Tables):
    f = tr.facts(claims(t))
    return f.select(tr.nt_line(F.col("s"), F.col("p"), F.col("o"), "https://x/").alias("line"))


@query("q166_label_triples", f"""WITH {m.REC}, {m.DOC}, {m.VOCAB} SELECT concept_id AS s, 'skos:prefLabel' AS p, alias AS o FROM alias
  UNION ALL SELECT concept_id, 'skos:altLabel', alias FROM alias""")
def label_triples(t: Tables):
    return tr.label_triples(m.vocabulary(t).concepts)


@query("q14_relationship_evidence", f"""WITH {m.REC}, {m.DOC}
  SELECT portal_id AS source, 'listsRegistration' AS predicate, record_id AS target, evidence_id, 'source_catalog_observed' AS status FROM rec
  UNION ALL SELECT record_id, 'reportedProvider', 'org-' || p_size, evidence_id, 'provider_reported_in_catalog' FROM rec
  UNION ALL SELECT record_id, 'hasDocumentedField', record_id || ':' || ordinal, evidence_id, 'definition_observed_not_data_validated' FROM doc""")
def relationship_evidence(t: Tables):
    return cv.relationship_evidence(m.records(t), m.documented(t))


@query("q125_broken_references", """SELECT 'rel-' || c_custkey AS id, u AS problem FROM (SELECT c_custkey, unnest([
    CASE WHEN c_nationkey >= 20 THEN 'unknown_target' END, CASE WHEN c_acctbal < 0 THEN 'no_evidence' END,
    CASE WHEN c_acctbal >= 0 AND c_mktsegment = 'BUILDING' THEN 'unknown_evidence' END]) AS u FROM customer) WHERE u IS NOT NULL""")
def broken_references(t: Tables):
    rel = t.customer.select(
        F.concat(F.lit("rel-"), _txt("c_custkey")).alias("id"), F.col("c_name").alias("source"), F.col("c_nationkey").cast("string").alias("target"),
        F.when(F.col("c_acctbal") < 0, F.array().cast("array<string>")).otherwise(F.array("c_mktsegment")).alias("evidence_ids"))
    nodes = t.customer.select(F.col("c_name").alias("id")).unionAll(t.nation.filter("n_nationkey < 20").select(_txt("n_nationkey")))
    ev = t.customer.filter("c_mktsegment <> 'BUILDING'").select(F.col("c_mktsegment").alias("id")).distinct()
    return rc.broken_references(rel, nodes, ev)


@query("q126_path_breaks", """WITH s AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS prev FROM
    (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
  SELECT l_orderkey, CAST(l_linenumber - 1 AS INTEGER) AS pos FROM s WHERE l_linenumber <> 1 AND (prev IS NULL OR prev <> l_linenumber - 1)""")
def path_breaks(t: Tables):
    steps = t.lineitem.select("l_orderkey", (F.col("l_linenumber") - 1).alias("pos"), (F.col("l_linenumber") - 1).alias("source"),
                              F.col("l_linenumber").alias("target")).distinct()
    last = steps.groupBy("l_orderkey").agg(F.max("target").alias("goal"))
    steps = steps.join(last, "l_orderkey").withColumn("root", F.lit(0))
    return rc.path_breaks(steps, ["l_orderkey"], "root", "goal").select("l_orderkey", "pos")


_NAMED = """CASE WHEN x LIKE 'rdf:%' THEN 'http://www.w3.org/1999/02/22-rdf-syntax-ns#' || substr(x, 5) ELSE 'https://x/' || replace(x, '#', '%23') END"""


@query("q185_statement_lines", f"""WITH {_CLAIMS}, st AS (SELECT u.s AS s, u.p AS p, u.o AS o FROM (SELECT unnest([
    {{'s': id, 'p': 'rdf:type', 'o': 'RelationshipClaim'}}, {{'s': id, 'p': 'rdf:subject', 'o': s}}, {{'s': id, 'p': 'rdf:predicate', 'o': p}},
    {{'s': id, 'p': 'rdf:object', 'o': o}}, {{'s': id, 'p': 'claimStatus', 'o': status}}, {{'s': id, 'p': 'evidence', 'o': evidence_id}}]) AS u FROM claim)
  UNION ALL SELECT DISTINCT s, p, o FROM claim WHERE status = 'documented')
  SELECT '<' || {_NAMED.replace("x LIKE", "s LIKE").replace("(x,", "(s,")} || '> <' || {_NAMED.replace("x LIKE", "p LIKE").replace("(x,", "(p,")} || '> '
    || CASE WHEN p = 'claimStatus' THEN '"' || o || '"' ELSE '<' || {_NAMED.replace("x LIKE", "o LIKE").replace("(x,", "(o,")} || '>' END || ' .' AS line FROM st""")
def statement_lines(t: Tables):
    s, p, o = F.col("s"), F.col("p"), F.col("o")
    return tr.claims_to_triples(claims(t)).select(tr.nt_line(s, p, o, "https://x/", tr.names_resource(p)).alias("line"))
