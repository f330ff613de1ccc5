"""Queries over quality scores, review workflow and join assessment."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.operators import joins as jn
from catalith.operators import quality as qa
from catalith.operators import review as rv
from catalith.plans.graph import discovery_edges, discovery_nodes
from catalith.plans.registry import Tables, query


def _metrics(t: Tables):
    g = t.lineitem.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_linenumber").alias("d"), F.count_if(F.col("l_tax") > 0).alias("v"),
        F.max("l_linenumber").alias("mx"), F.count_if(F.col("l_returnflag") == "R").alias("r"), F.min("l_quantity").alias("q"))
    return g.select(
        "l_suppkey", (F.col("r") > F.col("n") / 3).alias("source_identity"), F.lit(True).alias("methodology"),
        F.when(F.col("q") < 2, F.lit(True)).alias("definitions_and_units"), (F.col("mx") > 6).alias("revision_policy"),
        F.col("d").cast("double").alias("covered_unique_units"), F.lit(7.0).alias("expected_unique_units"),
        F.col("v").cast("double").alias("valid_required_values"), F.col("n").cast("double").alias("expected_required_values"),
        F.when(F.col("mx") > 5, F.lit("applicable")).otherwise(F.lit("unknown")).alias("applicability"),
        (F.col("q") / 2).alias("overdue_release_cycles"), F.lit(None).cast("string").alias("not_applicable_reason"))


_SCORE = """g AS (SELECT l_suppkey, count(*) AS n, count(DISTINCT l_linenumber) AS d, count(*) FILTER (l_tax > 0) AS v,
    max(l_linenumber) AS mx, count(*) FILTER (l_returnflag = 'R') AS r, min(l_quantity) AS q FROM lineitem GROUP BY 1),
  a AS (SELECT l_suppkey, CASE WHEN q < 2 THEN 10.0 * ((r > n / 3)::INT + 1 + 1 + (mx > 6)::INT) / 4 END AS reliability,
    10.0 * d / 7 AS coverage, CASE WHEN mx > 5 THEN 10 * greatest(0.0, 1 - q / 2 / 3) END AS freshness, 10.0 * v / n AS completeness FROM g)"""


@query("q34_quality_score", f"""WITH {_SCORE}, k AS (SELECT *, (reliability IS NOT NULL)::INT + (coverage IS NOT NULL)::INT + (freshness IS NOT NULL)::INT + (completeness IS NOT NULL)::INT AS n FROM a)
  SELECT l_suppkey, round(reliability, 6) AS reliability, round(coverage, 6) AS coverage, round(freshness, 6) AS freshness,
    round(completeness, 6) AS completeness, round(reliability * 0.3 + coverage * 0.25 + freshness * 0.2 + completeness * 0.25, 6) AS overall_score,
    n / 4.0::DOUBLE AS assessment_completion_ratio, CASE n WHEN 4 THEN 'assessed' WHEN 0 THEN 'not_assessed' ELSE 'partial' END AS status FROM k""")
def quality_score(t: Tables):
    s = qa.score_qa(_metrics(t))
    rounded = [F.round(c, 6).alias(c) for c in ("reliability", "coverage", "freshness", "completeness", "overall_score")]
    return s.select("l_suppkey", *rounded, "assessment_completion_ratio", "status")


@query("q108_metric_errors", """SELECT o_orderkey, concat_ws('; ', CASE WHEN o_totalprice < 5000 THEN 'overdue_release_cycles: not a finite nonnegative number' END,
    CASE WHEN o_totalprice <> floor(o_totalprice) THEN 'covered_unique_units: counts must be integers' END,
    CASE WHEN o_totalprice > 50000 THEN 'covered_unique_units: exceeds its denominator' END,
    CASE WHEN o_orderstatus = 'P' THEN 'not-applicable freshness requires a reason' END) AS errors FROM orders""")
def metric_errors(t: Tables):
    o = t.orders.select(
        "o_orderkey", F.col("o_totalprice").alias("covered_unique_units"), F.lit(50000.0).alias("expected_unique_units"),
        F.lit(None).cast("double").alias("valid_required_values"), F.lit(0.0).alias("expected_required_values"),
        F.when(F.col("o_totalprice") < 5000, F.lit(-1.0)).otherwise(F.lit(0.0)).alias("overdue_release_cycles"),
        F.when(F.col("o_orderstatus") == "P", F.lit("not_applicable")).otherwise(F.lit("applicable")).alias("applicability"),
        F.lit("").alias("not_applicable_reason"))
    return o.select("o_orderkey", F.array_join(qa.metric_errors(), "; ").alias("errors"))


@query("q35_quality_counters", """SELECT o_custkey, count(DISTINCT (o_orderpriority, o_orderstatus)) AS covered_unique_units,
  (SELECT count(DISTINCT o_orderpriority) * count(DISTINCT o_orderstatus) FROM orders) AS expected_unique_units FROM orders GROUP BY 1""")
def quality_counters(t: Tables):
    return qa.coverage_counters(t.orders, ["o_orderpriority", "o_orderstatus"],
                                [t.orders.select("o_orderpriority"), t.orders.select("o_orderstatus")], ["o_custkey"])


@query("q167_completeness", """SELECT source, CAST(count(*) FILTER (trim(lang) NOT IN ('', 'fr')) + count(*) AS BIGINT) AS valid_required_values,
  count(*) * 2 AS expected_required_values FROM documents GROUP BY 1""")
def completeness(t: Tables):
    return qa.completeness_counters(t.documents, ["lang", "doc_id"], ("", "fr"), ["source"])


@query("q105_gate", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'fail' WHEN o_orderstatus = 'P' OR o_totalprice < 100000 THEN 'unknown' ELSE 'pass' END AS gate FROM orders""")
def gate(t: Tables):
    s = F.col("o_orderstatus")
    ok = F.lit("pass")
    return t.orders.select("o_orderkey", qa.gate(
        F.when(s == "F", F.lit("fail")).when(s == "P", F.lit(None)).otherwise(ok),
        F.when(F.col("o_totalprice") < 100000, F.lit("unknown")).otherwise(ok), ok, ok).alias("gate"))


@query("q106_site_summary", """SELECT o_orderpriority AS site, o_orderstatus AS topic, count(*) AS registered_dataset_count, count(s) AS assessed_dataset_count,
  round((count(*) - count(s)) / count(*)::DOUBLE, 6) AS unassessed_ratio, round(quantile_cont(s, 0.5), 6) AS median_score, min(s) AS min_score, max(s) AS max_score
  FROM (SELECT *, CASE WHEN o_totalprice > 100000 THEN round(o_totalprice / 100000, 2) END AS s FROM orders) GROUP BY 1, 2""")
def site_summary(t: Tables):
    o = t.orders.select(F.col("o_orderpriority").alias("site"), F.col("o_orderstatus").alias("topic"), F.col("o_orderdate").alias("assessed_at"),
                        F.when(F.col("o_totalprice") > 100000, F.round(F.col("o_totalprice") / 100000, 2)).alias("overall_score"))
    s = qa.site_summary(o, ("site", "topic"))
    return s.select("site", "topic", "registered_dataset_count", "assessed_dataset_count", F.round("unassessed_ratio", 6).alias("unassessed_ratio"),
                    F.round("median_score", 6).alias("median_score"), "min_score", "max_score")


@query("q107_subset_plan", """SELECT count(*) AS rows, CAST(sum(length('{"l_orderkey":' || l_orderkey || ',"l_returnflag":"' || l_returnflag || '"}')) AS BIGINT) AS bytes,
  CAST(1000 AS BIGINT) AS budget_bytes, 'hold' AS decision FROM lineitem WHERE l_quantity > 10""")
def subset_plan(t: Tables):
    return qa.subset_plan(t.lineitem, ["l_orderkey", "l_returnflag"], 1000, F.col("l_quantity") > 10)


_STATE = {"view": "under_review", "click": "approved", "signup": "stale", "error": "approved", "purchase": "under_review"}
_STATE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _STATE.items()) + " END"
_STEP = """CASE WHEN (c = 'proposed' AND to_state = 'under_review') OR (c = 'under_review' AND to_state = 'approved')
  OR (c = 'approved' AND to_state = 'stale') OR (c = 'stale' AND to_state = 'under_review') THEN to_state ELSE c END"""


def _events(t: Tables):
    to = F.lit(None).cast("string")
    for k, v in _STATE.items():
        to = F.when(F.col("event_type") == k, F.lit(v)).otherwise(to)
    return t.events.select("event_id", "ts", "user_id", to.alias("to_state"))


_RUN = f"""RECURSIVE e AS (SELECT event_id, user_id, {_STATE_SQL} AS to_state, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
  run(user_id, i, event_id, before, after) AS (
  SELECT user_id, i, event_id, 'proposed', {_STEP.replace("c ", "'proposed' ").replace("ELSE c", "ELSE 'proposed'")} FROM e WHERE i = 1
  UNION ALL SELECT e.user_id, e.i, e.event_id, run.after, {_STEP.replace("c ", "run.after ").replace("ELSE c", "ELSE run.after").replace("to_state", "e.to_state")}
  FROM run JOIN e ON e.user_id = run.user_id AND e.i = run.i + 1)"""


@query("q37_review_state", f"""WITH {_RUN} SELECT event_id, user_id, before AS state_before, after AS state_after, before <> after AS accepted FROM run""")
def review_state(t: Tables):
    return rv.apply_review_events(_events(t), "user_id", ["ts", "event_id"], "to_state").select(
        "event_id", "user_id", "state_before", "state_after", "accepted")


@query("q168_current_states", f"""WITH {_RUN} SELECT user_id, arg_max(after, i) AS state, count(*) FILTER (before <> after) AS accepted_events,
  count(*) FILTER (before = after) AS rejected_events FROM run GROUP BY 1""")
def current_states(t: Tables):
    a = rv.apply_review_events(_events(t), "user_id", ["ts", "event_id"], "to_state")
    return rv.current_states(a, "user_id", ["ts", "event_id"])


@query("q38_fingerprint_stale", """SELECT p_partkey AS id, CASE WHEN p_size <= 10 THEN 'proposed' WHEN p_type = 'PROMO' OR p_retailprice < 950 THEN 'stale' ELSE 'approved' END AS state_now,
  concat_ws(',', CASE WHEN p_retailprice < 950 THEN 'evidence_withdrawal' END, CASE WHEN p_retailprice >= 950 AND p_type = 'PROMO' THEN 'fp_changed' END) AS triggers FROM part""")
def fingerprint_stale(t: Tables):
    a = t.part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 10, F.lit("approved")).otherwise(F.lit("proposed")).alias("state"),
                      F.sha2("p_name", 256).alias("fp"))
    cur = t.part.filter("p_retailprice >= 950").select(F.col("p_partkey").alias("id"), F.sha2(
        F.when(F.col("p_type") == "PROMO", F.upper("p_name")).otherwise(F.col("p_name")), 256).alias("fp"))
    return rv.invalidate(a, cur, ["fp"]).select("id", "state_now", F.array_join("triggers", ",").alias("triggers"))


@query("q101_approval_valid", """SELECT o_orderkey, o_totalprice >= 50000 AND o_orderstatus = 'F' AS valid,
  CASE WHEN o_totalprice < 50000 THEN 'reviewer_id,decision_rationale' ELSE '' END AS missing FROM orders""")
def approval_valid(t: Tables):
    poor = F.col("o_totalprice") < 50000
    o = t.orders.select(
        "o_orderkey", F.when(~poor, F.lit("rev-1")).alias("reviewer_id"), F.col("o_orderdate").alias("reviewed_at"),
        F.lit("fp").alias("proposal_fingerprint"), F.lit("ev").alias("evidence_snapshots"), F.lit("m").alias("review_method"),
        F.lit("scope").alias("applicability_scope"), F.when(poor, F.lit("")).otherwise(F.lit("why")).alias("decision_rationale"),
        F.when(F.col("o_orderstatus") == "F", F.lit("human")).otherwise(F.lit("ai")).alias("actor_kind"))
    return rv.approval_valid(o).select("o_orderkey", "valid", F.array_join("missing_fields", ",").alias("missing"))


def _queue_parts(t: Tables):
    sample = t.part.filter("p_size > 20").select(F.col("p_partkey").alias("id"), F.lit("pending").alias("status"), F.lit(None).cast("string").alias("decision"))
    queue = t.part.filter("p_size > 15 and p_type = 'PROMO'").select(F.col("p_partkey").alias("id"), F.lit("done").alias("status"), F.lit("approve").alias("decision"))
    outside = t.part.filter("p_size > 10 and p_type in ('PROMO', 'SMALL')").select(F.col("p_partkey").alias("id"), F.lit("done").alias("status"), F.lit("reject").alias("decision"))
    return sample, queue, outside


@query("q102_carry_reviews", """SELECT p_partkey AS id, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'done' ELSE 'pending' END AS status,
  CASE p_type WHEN 'PROMO' THEN 'approve' WHEN 'SMALL' THEN 'reject' END AS decision FROM part WHERE p_size > 20""")
def carry_reviews(t: Tables):
    return rv.carry_reviews(*_queue_parts(t))[0]


@query("q169_reviews_outside", """SELECT p_partkey AS id, 'done' AS status, CASE WHEN p_type = 'PROMO' AND p_size > 15 THEN 'approve' ELSE 'reject' END AS decision
  FROM part WHERE p_size BETWEEN 11 AND 20 AND p_type IN ('PROMO', 'SMALL')""")
def reviews_outside(t: Tables):
    return rv.carry_reviews(*_queue_parts(t))[1]


_EDGES = """edge AS (SELECT 'q-' || r_regionkey AS source, 'interpretedAs' AS predicate, 'c-' || r_regionkey AS target, 'query_interpretation' AS role FROM region
  UNION ALL SELECT 'c-' || n_regionkey, 'hasIndicator', 'i-' || n_nationkey, 'indicator_definition' FROM nation
  UNION ALL SELECT 'i-' || s_nationkey, 'availableFrom', 'd-' || s_suppkey, 'metadata_mapping' FROM supplier
  UNION ALL SELECT 'd-' || s_suppkey, 'providedBy', 'p-' || s_nationkey, 'source_provenance' FROM supplier),
  edges AS (SELECT *, 'r-' || substr(sha256(source || '|' || predicate || '|' || target), 1, 12) AS id FROM edge)"""


@query("q103_review_tasks", f"""WITH {_EDGES} SELECT id AS relation_id, role, 'check ' || role AS review_method, 'proposed' AS workflow_state, true AS unique_fingerprint FROM edges""")
def review_tasks(t: Tables):
    edges = discovery_edges(t)
    ev = edges.select(F.explode("evidence_ids").alias("id")).distinct().withColumn("sha256", F.sha2("id", 256))
    methods = edges.select("role").distinct().withColumn("review_method", F.concat(F.lit("check "), "role"))
    tasks = rv.review_tasks(edges, discovery_nodes(t), ev, methods)
    twins = tasks.groupBy("proposal_fingerprint").agg(F.count(F.lit(1)).alias("n"))
    return tasks.join(twins, "proposal_fingerprint").select(
        "relation_id", "role", "review_method", "workflow_state", (F.col("n") == 1).alias("unique_fingerprint"))


@query("q170_review_table", f"""WITH {_EDGES} SELECT role, id, CASE WHEN role = 'metadata_mapping' THEN 'under_review' ELSE 'proposed' END AS state, 'ev-' || source AS evidence FROM edges""")
def review_table(t: Tables):
    edges = discovery_edges(t)
    revs = edges.filter("role = 'metadata_mapping'").select(F.col("id").alias("relation_id"), F.lit("under_review").alias("workflow_state"), F.lit("n").alias("note"))
    return rv.review_table(edges, revs).select("role", "id", "state", F.array_join("evidence_ids", ",").alias("evidence"))


@query("q104_issue_impact", """SELECT s_suppkey AS issue_id, CAST(1 AS BIGINT) AS datasets, CAST(2 AS BIGINT) AS relations, CAST(2 AS BIGINT) AS reviews FROM supplier WHERE s_acctbal > 0""")
def issue_impact(t: Tables):
    sid = F.concat(F.lit("d-"), F.col("s_suppkey").cast("string"))
    issues = t.supplier.select(F.col("s_suppkey").alias("issue_id"), sid.alias("dataset_id"), F.lit("v1").alias("dataset_version"),
                               F.when(F.col("s_acctbal") > 0, F.lit("reproduced")).otherwise(F.lit("reported")).alias("state"))
    sets = t.supplier.select(sid.alias("dataset_id"), F.lit("v1").alias("dataset_version"))
    edges = discovery_edges(t)
    return rv.issue_impact(issues, sets, edges, edges.select(F.col("id").alias("relation_id")))


def _assess_sql(name, left, lk, right, rk):
    return f"""SELECT '{name}' AS pair, CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(r) AS BIGINT) AS right_rows, count(l) AS left_keys, count(r) AS right_keys,
    count(*) FILTER (l IS NOT NULL AND r IS NOT NULL) AS matched_keys, CAST(sum(l * r) AS BIGINT) AS joined_rows,
    (CASE WHEN max(l) > 1 THEN 'many' ELSE 'one' END) || '_to_' || (CASE WHEN max(r) > 1 THEN 'many' ELSE 'one' END) AS cardinality,
    round(sum(CASE WHEN r IS NOT NULL THEN l END) / sum(l)::DOUBLE, 6) AS left_coverage, round(sum(CASE WHEN l IS NOT NULL THEN r END) / sum(r)::DOUBLE, 6) AS right_coverage,
    CAST(sum(l * r) - greatest(sum(CASE WHEN r IS NOT NULL THEN l END), sum(CASE WHEN l IS NOT NULL THEN r END)) AS BIGINT) AS duplicate_expansion
  FROM (SELECT {lk} AS k, count(*) AS l FROM {left} GROUP BY 1) FULL JOIN (SELECT {rk} AS k, count(*) AS r FROM {right} GROUP BY 1) USING (k)"""


@query("q36_join_assessment", _assess_sql("orders-lineitem", "orders", "o_orderkey", "lineitem", "l_orderkey") + " UNION ALL "
       + _assess_sql("customer-orders", "customer", "c_custkey", "orders", "o_custkey") + " UNION ALL "
       + _assess_sql("supplier-customer", "supplier", "s_nationkey", "customer", "c_nationkey"))
def join_assessment(t: Tables):
    def one(name, left, lk, right, rk):
        a = jn.assess_join(left, right, [lk], [rk])
        return a.select(F.lit(name).alias("pair"), "left_rows", "right_rows", "left_keys", "right_keys", "matched_keys", "joined_rows", "cardinality",
                        F.round("left_coverage", 6).alias("left_coverage"), F.round("right_coverage", 6).alias("right_coverage"), "duplicate_expansion")

    return (one("orders-lineitem", t.orders, "o_orderkey", t.lineitem, "l_orderkey")
            .unionAll(one("customer-orders", t.customer, "c_custkey", t.orders, "o_custkey"))
            .unionAll(one("supplier-customer", t.supplier, "s_nationkey", t.customer, "c_nationkey")))


@query("q109_crosswalk", """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'old-' || o_orderpriority WHEN o_orderstatus = 'P' THEN NULL ELSE 'new-' || o_orderpriority END AS target_code,
  CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus = 'P' THEN 'unknown' ELSE 'match' END AS crosswalk_status FROM orders""")
def crosswalk(t: Tables):
    def at(x):
        return F.lit(x).cast("timestamp")

    codes = t.orders.select(F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("code"), "o_orderpriority", "o_orderstatus").distinct()
    old = codes.select("code", F.concat(F.lit("old-"), "o_orderpriority").alias("target_code"), at("1900-01-01").alias("valid_from"), at("1995-12-31 23:59:59.999999").alias("valid_to"))
    new = codes.filter("o_orderstatus <> 'P'").select("code", F.concat(F.lit("new-"), "o_orderpriority").alias("target_code"), at("1996-01-01").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    o = t.orders.withColumn("area", F.concat_ws("/", "o_orderpriority", "o_orderstatus"))
    return jn.crosswalk_join(o, old.unionAll(new), "area", "o_orderdate").select("o_orderkey", "target_code", "crosswalk_status")


@query("q110_resolve_references", """SELECT l_orderkey, l_linenumber, CAST(p_partkey AS VARCHAR) AS target_key, true AS resolved, 'r' || p_partkey AS first_target FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 25
  UNION ALL SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR), false, NULL FROM lineitem LEFT JOIN part ON p_partkey = l_partkey WHERE p_size <= 25 OR p_size IS NULL""")
def resolve_references(t: Tables):
    links = t.lineitem.select("l_orderkey", "l_linenumber", F.concat(F.lit("https://p.example/data/"), F.col("l_partkey").cast("string"), F.lit("/openapi.do")).alias("url"))
    rec = t.part.filter("p_size > 25").select(F.concat(F.lit("r"), F.col("p_partkey").cast("string")).alias("id"), F.lit("p").alias("portal_id"), F.col("p_partkey").cast("string").alias("dataset_key"))
    out = jn.resolve_references(links, rec, "url", "^https://p\\.example/data/([0-9]+)/openapi\\.do$", "p")
    return out.select("l_orderkey", "l_linenumber", "target_key", "resolved", "first_target")


@query("q111_code_references", """SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) THEN 'source_reference_observed' ELSE 'code_table_unresolved' END AS status FROM lineitem""")
def code_references(t: Tables):
    tables = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("source_name"), F.concat(F.lit("code:"), "s_name").alias("id"), F.lit("ev").alias("evidence_id"))
    return jn.code_list_references(t.lineitem, tables, "l_suppkey").select("l_orderkey", "l_linenumber", "status")


@query("q15_orphans", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def orphans(t: Tables):
    return jn.orphans(t.orders, t.customer.filter("c_acctbal > 0"), ["o_custkey"], ["c_custkey"]).select("o_orderkey", "o_custkey")


@query("q112_attribute_mismatch", """SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE nullif(l_linestatus, 'F') IS DISTINCT FROM nullif(o_orderstatus, 'P')""")
def attribute_mismatch(t: Tables):
    child = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_linenumber", F.nullif("l_linestatus", F.lit("F")).alias("st"))
    parent = t.orders.select(F.col("o_orderkey").alias("k"), F.nullif("o_orderstatus", F.lit("P")).alias("os"))
    return jn.attribute_mismatches(child, parent, ["k"], [("st", "os")]).select(F.col("k").alias("l_orderkey"), "l_linenumber")


@query("q113_first_per_key", """SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1""")
def first_per_key(t: Tables):
    return jn.first_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey"])


@query("q186_site_rollup", """SELECT o_orderpriority AS site, o_orderstatus AS topic, CAST(grouping(o_orderpriority) + grouping(o_orderstatus) AS INTEGER) AS level,
  count(*) AS registered_dataset_count, count(s) AS assessed_dataset_count, round(quantile_cont(s, 0.5), 6) AS median_score, min(s) AS min_score, max(s) AS max_score
  FROM (SELECT *, CASE WHEN o_totalprice > 100000 THEN round(o_totalprice / 100000, 2) END AS s FROM orders) GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def site_rollup(t: Tables):
    o = t.orders.select(F.col("o_orderpriority").alias("site"), F.col("o_orderstatus").alias("topic"), F.col("o_orderdate").alias("assessed_at"),
                        F.when(F.col("o_totalprice") > 100000, F.round(F.col("o_totalprice") / 100000, 2)).alias("overall_score"))
    return qa.site_summary(o, ("site", "topic"), subtotals=True).select(
        "site", "topic", F.col("level").cast("int").alias("level"), "registered_dataset_count", "assessed_dataset_count",
        F.round("median_score", 6).alias("median_score"), "min_score", "max_score")


@query("q187_approval_by_kind", """SELECT o_orderkey, o_orderstatus = 'O' AND o_totalprice >= 50000 AS valid,
  CASE WHEN o_orderstatus = 'F' THEN 'input_versions,variable_definitions,sample_size,preprocessing,code_hash,result,uncertainty,limitations'
    WHEN o_orderstatus = 'P' THEN concat_ws(',', 'metadata_version,concept_version,embedding_model_version',
      CASE WHEN o_totalprice < 50000 THEN 'field_scores' END, 'evaluation_set_version') ELSE '' END AS missing FROM orders""")
def approval_by_kind(t: Tables):
    rows = t.orders.select(
        "o_orderkey", F.lit("rev-1").alias("reviewer_id"), F.col("o_orderdate").alias("reviewed_at"), F.lit("fp").alias("proposal_fingerprint"),
        F.lit("ev").alias("evidence_snapshots"), F.lit("m").alias("review_method"), F.lit("scope").alias("applicability_scope"),
        F.lit("why").alias("decision_rationale"), F.when(F.col("o_totalprice") >= 50000, F.lit("human")).otherwise(F.lit("ai")).alias("actor_kind"),
        F.when(F.col("o_orderstatus") == "F", F.lit("statistical_relation")).when(F.col("o_orderstatus") == "P", F.lit("semantic_topic"))
        .otherwise(F.lit("join")).alias("kind"), F.lit("run-1").alias("analysis_run_id"),
        F.when(F.col("o_totalprice") >= 50000, F.lit("0.5")).otherwise(F.lit("")).alias("field_scores"))
    return rv.approval_valid(rows, kind="kind").select("o_orderkey", "valid", F.array_join("missing_fields", ",").alias("missing"))
