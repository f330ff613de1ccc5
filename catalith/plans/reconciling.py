"""Queries over quarantine, coverage, listings and consistency checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.layout import dictionary_join, fits_broadcast
from catalith.operators import coverage as cv
from catalith.operators import graph_store as gs
from catalith.operators import joins as jn
from catalith.operators import reconcile as rc
from catalith.operators import registry as rg
from catalith.operators import scan as sc
from catalith.plans import model as m
from catalith.plans.registry import Tables, query
from catalith.sources import catalog as ct
from catalith.sources import institutions as inst
from catalith.sources import vocabulary as vc

_BAD = "o_orderstatus = 'P'"
_SPLIT = f"""t AS (SELECT o_orderkey, {_BAD} AS bad, lead({_BAD}) OVER (ORDER BY o_orderkey) AS next_bad FROM orders),
  q AS (SELECT o_orderkey, CASE WHEN bad THEN 'invalid_record_shape_or_identifiers' WHEN next_bad THEN 'followed_by_malformed_continuation' END AS quarantine_reason FROM t)"""


def _split(t: Tables):
    rows = t.orders.withColumn("row_no", F.col("o_orderkey") + 1)
    return rc.quarantine_split(rows, "row_no", F.col("o_orderstatus") != "P")


@query("q07_quarantine", f"WITH {_SPLIT} SELECT o_orderkey, quarantine_reason FROM q")
def quarantine(t: Tables):
    return _split(t).select("o_orderkey", "quarantine_reason")


@query("q122_accounting", f"""WITH {_SPLIT} SELECT count(*) AS source_rows, count(*) FILTER (quarantine_reason IS NULL) AS imported,
  count(*) FILTER (quarantine_reason LIKE 'inv%') AS invalid, count(*) FILTER (quarantine_reason LIKE 'fol%') AS implicated, true AS balanced FROM q""")
def accounting(t: Tables):
    return rc.accounting_identity(_split(t))


@query("q158_bulk_validity", """SELECT p_partkey, p_size > 9 AND p_type IN ('PROMO', 'SMALL') AND p_size <> 20 AS valid FROM part""")
def bulk_validity(t: Tables):
    key = F.when(F.col("p_size") > 9, F.lpad(F.col("p_partkey").cast("string"), 8, "0")).otherwise(F.col("p_name"))
    kind = F.when(F.col("p_type") == "PROMO", F.lit("FILE")).when(F.col("p_type") == "SMALL", F.lit("STD")).otherwise(F.col("p_type"))
    p = t.part.select("p_partkey", key.alias("list_key"), kind.alias("kind"), F.col("p_brand").alias("provider"), F.col("p_size"))
    return p.select("p_partkey", ct.bulk_row_valid(F.col("p_size") != 20).alias("valid"))


@query("q26_pagination", """SELECT o_orderpriority AS portal, count(DISTINCT o_custkey) AS pages, count(DISTINCT CASE WHEN o_totalprice < 2000 THEN o_custkey END) AS failed_pages,
  count(*) AS received, count(DISTINCT o_orderdate) AS unique_records, count(*) - count(DISTINCT o_orderdate) AS duplicates,
  min(CASE WHEN o_orderstatus = 'P' THEN 7 ELSE 5 END) AS reported_total_min, max(CASE WHEN o_orderstatus = 'P' THEN 7 ELSE 5 END) AS reported_total_max, false AS complete FROM orders GROUP BY 1""")
def pagination(t: Tables):
    o = t.orders.select(F.col("o_orderpriority").alias("portal"), F.col("o_custkey").alias("page"), F.col("o_orderdate").alias("record"),
                        F.when(F.col("o_orderstatus") == "P", F.lit(7)).otherwise(F.lit(5)).alias("total"), (F.col("o_totalprice") >= 2000).alias("ok"))
    return rc.pagination_report(o, "portal", "page", "total", "record", "ok")


@query("q28_compare_sequences", """WITH a AS (SELECT l_orderkey AS k, l_linenumber AS p, l_returnflag AS v FROM lineitem), b AS (SELECT l_orderkey AS k, l_linenumber AS p,
    CASE WHEN l_quantity > 40 THEN 'X' ELSE l_returnflag END AS v FROM lineitem WHERE l_linenumber < 6),
  j AS (SELECT coalesce(a.k, b.k) AS k, a.v AS av, b.v AS bv, a.k IS NOT NULL AND b.k IS NOT NULL AND a.v = b.v AS same FROM (SELECT *, row_number() OVER (PARTITION BY k, p) AS r FROM a) a
    FULL JOIN (SELECT *, row_number() OVER (PARTITION BY k, p) AS r FROM b) b ON a.k = b.k AND a.p = b.p),
  o AS (SELECT k, count(DISTINCT v) FILTER (l AND NOT r) AS only_in_left, count(DISTINCT v) FILTER (r AND NOT l) AS only_in_right FROM
    (SELECT k, v, bool_or(l) AS l, bool_or(r) AS r FROM (SELECT k, v, true AS l, false AS r FROM a UNION ALL SELECT k, v, false, true FROM b) GROUP BY 1, 2) GROUP BY k)
  SELECT k AS l_orderkey, count(av) AS left_length, count(bv) AS right_length, count(*) FILTER (same) AS equal_positions, count(*) FILTER (NOT same) AS different_positions,
    any_value(only_in_left) AS only_in_left, any_value(only_in_right) AS only_in_right, count(*) FILTER (NOT same) = 0 AS exact_match FROM j JOIN o USING (k) GROUP BY k""")
def compare_sequences(t: Tables):
    a = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("v"))
    b = t.lineitem.filter("l_linenumber < 6").select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") > 40, F.lit("X")).otherwise(F.col("l_returnflag")).alias("v"))
    return jn.compare_sequences(a, b, ["l_orderkey"], "l_linenumber", "v")


@query("q123_verify_hashes", """SELECT doc_id FROM documents WHERE lang = 'fr' OR strlen(text) <> n_chars""")
def verify_hashes(t: Tables):
    d = t.documents.withColumn("sha", F.sha2(F.when(F.col("lang") != "fr", F.col("text")).otherwise(F.lit("other")), 256))
    return rc.verify_hashes(d, "text", "sha", "n_chars").select("doc_id")


@query("q124_duplicate_keys", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
  UNION ALL SELECT l_orderkey, NULL, count(*) FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def duplicate_keys(t: Tables):
    a = rc.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
    b = rc.duplicate_keys(t.lineitem, ["l_orderkey"]).select("l_orderkey", F.lit(None).cast("int").alias("l_linenumber"), "n")
    return a.unionByName(b)


@query("q127_table_difference", """SELECT n_name, CAST(1 AS BIGINT) AS copies, s AS side, k FROM (SELECT DISTINCT 'x' AS x), LATERAL (
    SELECT o_orderstatus || c_mktsegment AS n_name, 'only_in_stored' AS s, o_orderkey AS k FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 400000
    UNION ALL SELECT o_orderstatus || c_mktsegment, 'only_in_recomputed', o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice < 3000)""")
def table_difference(t: Tables):
    j = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(
        F.concat("o_orderstatus", "c_mktsegment").alias("n_name"), F.col("o_orderkey").alias("k"), "o_totalprice")
    return rc.table_difference(j.filter("o_totalprice >= 3000").drop("o_totalprice"), j.filter("o_totalprice <= 400000").drop("o_totalprice"))


@query("q128_total_differences", """SELECT o_custkey, count(DISTINCT o_orderpriority) AS sources, min(o_totalprice) AS lowest, max(o_totalprice) AS highest, min(o_totalprice) <> max(o_totalprice) AS unresolved FROM orders GROUP BY 1""")
def total_differences(t: Tables):
    return rc.total_differences(t.orders, "o_custkey", "o_orderpriority", "o_totalprice")


@query("q129_list_lengths", """SELECT p_partkey, CAST(2 AS INTEGER) AS names, CAST(CASE WHEN p_type = 'PROMO' THEN 3 ELSE 2 END AS INTEGER) AS labels,
  concat_ws(',', CASE WHEN p_type = 'PROMO' THEN 'name_label_length_mismatch' END, CASE WHEN p_size <> 2 THEN 'declared_count_differs' END) AS issues FROM part WHERE p_type = 'PROMO' OR p_size <> 2""")
def list_lengths(t: Tables):
    p = t.part.withColumn("a", F.split("p_name", " ")).withColumn("b", F.when(F.col("p_type") == "PROMO", F.array_append(F.split("p_name", " "), F.lit("x"))).otherwise(F.split("p_name", " ")))
    return rc.list_length_issues(p, "p_partkey", "a", "b", "p_size").withColumn("issues", F.array_join("issues", ","))


@query("q172_duplicate_tables", """WITH d AS (SELECT l_orderkey AS k, string_agg(l_returnflag || l_linestatus || l_linenumber, ',' ORDER BY l_linenumber, l_returnflag, l_linestatus) AS body FROM lineitem GROUP BY 1),
  g AS (SELECT body, count(*) AS copies, min(k) AS first FROM d GROUP BY 1 HAVING count(*) > 1) SELECT k AS l_orderkey, copies, k = first AS is_first FROM d JOIN g USING (body)""")
def duplicate_tables(t: Tables):
    return rc.duplicate_tables(t.lineitem, ["l_orderkey"], "l_linenumber", ["l_returnflag", "l_linestatus"])


@query("q130_superseded", """SELECT 'o' || o_orderkey AS previous, 'o' || o_orderkey || '-retry' AS replacement, o_orderpriority <> '5-LOW' AS same_url FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def superseded(t: Tables):
    oid = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    first = t.orders.select(oid.alias("id"), F.when(F.col("o_orderstatus") == "F", F.lit("fetch_unresolved")).otherwise(F.lit("fetched")).alias("status"),
                            F.lit("e").alias("error"), F.col("o_orderpriority").alias("requested_url"))
    retry = t.orders.filter("o_totalprice > 100000").select(F.concat(oid, F.lit("-retry")).alias("id"), F.lit("fetched").alias("status"), F.lit(None).cast("string").alias("error"),
                                                            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("requested_url"))
    return rc.superseded_failures(first.unionAll(retry), "-retry$").select("previous", "replacement", "same_url")


@query("q131_check_report", """SELECT count(*) AS checks, count(*) FILTER (o_totalprice <= 1500) AS failures, bool_and(o_totalprice > 1500) AS passed FROM orders""")
def check_report(t: Tables):
    return rc.check_report(t.orders.select((F.col("o_totalprice") > 1500).alias("passed")))


@query("q132_two_pass", """WITH p AS (SELECT o_orderpriority AS s, 1 AS run, o_custkey AS r FROM orders WHERE o_totalprice > 50000 UNION ALL SELECT o_orderpriority, 2, o_custkey FROM orders WHERE o_totalprice < 200000),
  g AS (SELECT s, r, count(*) AS n, count(DISTINCT run) AS runs FROM p GROUP BY 1, 2)
  SELECT s AS subject, count(*) AS union_records, CAST(sum(n - runs) AS BIGINT) AS duplicates_within_passes, count(*) FILTER (runs = 1) AS seen_in_one_pass, 1000 AS reported_total, count(*) = 1000 AS complete FROM g GROUP BY 1""")
def two_pass(t: Tables):
    def run(n, cond):
        return t.orders.filter(cond).select(F.col("o_orderpriority").alias("subject"), F.lit(n).alias("run"), F.col("o_custkey").alias("record"), F.lit(1000).alias("total"))

    return rc.two_pass_reconcile(run(1, "o_totalprice > 50000").unionAll(run(2, "o_totalprice < 200000")), "subject", "run", "record", "total")


@query("q133_crosscheck", """SELECT o_orderstatus, a AS counted, b AS published, a IS NOT DISTINCT FROM b AS agrees FROM (SELECT o_orderstatus, count(*) AS a FROM orders GROUP BY 1)
  FULL JOIN (SELECT l_linestatus AS o_orderstatus, count(*) AS b FROM lineitem GROUP BY 1) USING (o_orderstatus)""")
def crosscheck(t: Tables):
    pub = t.lineitem.groupBy(F.col("l_linestatus").alias("o_orderstatus")).agg(F.count(F.lit(1)).alias("published"))
    return rc.crosscheck_breakdown(t.orders, "o_orderstatus", pub)


@query("q134_order_contiguity", """SELECT l_orderkey, min(l_linenumber) AS first_no, max(l_linenumber) AS last_no, count(*) AS rows, count(DISTINCT l_linenumber) AS distinct_numbers,
  min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*) AS contiguous FROM lineitem GROUP BY 1""")
def order_contiguity(t: Tables):
    return rc.order_contiguity(t.lineitem, ["l_orderkey"], "l_linenumber")


@query("q135_page_rows", """SELECT o_orderkey, o_orderkey + 1 AS expected_no FROM orders WHERE o_orderstatus = 'P'""")
def page_rows(t: Tables):
    size = 50
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") + 1).alias("no"),
                        (F.floor(F.col("o_orderkey") / size) + 1).alias("page"), F.pmod("o_orderkey", F.lit(size)).alias("pos"))
    return rc.page_row_identity(o, "no", "page", "pos", size).select("o_orderkey", "expected_no")


@query("q136_menu_sections", """SELECT c_custkey AS anchor, CASE WHEN c_acctbal < 0 THEN 'target_without_section' ELSE 'label_differs' END AS problem FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'""")
def menu_sections(t: Tables):
    nav = t.customer.select(F.col("c_custkey").alias("anchor"), F.col("c_name").alias("label"))
    sec = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("anchor"), F.when(F.col("c_mktsegment") == "BUILDING", F.lit("x")).otherwise(F.col("c_name")).alias("title"))
    return rc.menu_sections(nav, sec)


@query("q137_attribute_issues", """SELECT p_partkey, concat_ws(',', CASE WHEN p_size > 40 THEN 'unexpected_row_width' END, CASE WHEN p_type = 'PROMO' THEN 'length_not_specified' END) AS issues FROM part""")
def attribute_issues(t: Tables):
    p = t.part.withColumn("cells", F.when(F.col("p_size") > 40, F.array("p_name")).otherwise(F.array("p_name", "p_type"))).withColumn(
        "len", F.when(F.col("p_type") == "PROMO", F.lit(" ? ")).otherwise(F.lit("10")))
    return rc.attribute_issues(p, "cells", 2, "len").select("p_partkey", F.array_join("issues", ",").alias("issues"))


@query("q138_occurrence_history", """WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
  SELECT CASE WHEN n = 1 THEN 'first' ELSE 'repeat' END AS part, o_orderkey FROM r""")
def occurrence_history(t: Tables):
    first, rest = rc.occurrence_history(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select(F.lit("first").alias("part"), "o_orderkey").unionAll(rest.select(F.lit("repeat").alias("part"), "o_orderkey"))


@query("q139_set_relation", """WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer), b AS (SELECT DISTINCT o_custkey AS k FROM orders)
  SELECT *, only_left = 0 AND only_right = 0 AS equal, only_left = 0 AS left_is_subset FROM (
    SELECT count(a.k) AS left_values, count(b.k) AS right_values, count(*) FILTER (b.k IS NULL) AS only_left, count(*) FILTER (a.k IS NULL) AS only_right FROM a FULL JOIN b ON a.k = b.k)""")
def set_relation(t: Tables):
    return rc.set_relation(t.customer.select(F.col("c_custkey").alias("k")), t.orders.select(F.col("o_custkey").alias("k")), "k")


@query("q140_multiset_difference", """SELECT k, a AS left_copies, b AS right_copies FROM (SELECT k, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b FROM (
  SELECT l_suppkey AS k, 1 AS a, 0 AS b FROM lineitem UNION ALL SELECT o_custkey, 0, 1 FROM orders) GROUP BY 1) WHERE a <> b""")
def multiset_difference(t: Tables):
    return rc.multiset_difference(t.lineitem.select(F.col("l_suppkey").alias("k")), t.orders.select(F.col("o_custkey").alias("k")), "k")


@query("q173_detached_keys", """SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def detached_keys(t: Tables):
    return jn.orphans(t.lineitem.select("l_partkey").distinct(), t.part.filter("p_size > 10"), ["l_partkey"], ["p_partkey"])


@query("q141_evidence_ids", """SELECT 'c' || c_custkey AS evidence_id FROM customer UNION SELECT 'c' || o_custkey FROM orders UNION SELECT 'o' || o_orderkey FROM orders""")
def evidence_ids(t: Tables):
    a = t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("evidence_id"))
    b = t.orders.select(F.array(F.concat(F.lit("c"), F.col("o_custkey").cast("string")), F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))).alias("evidence_ids"))
    return rc.evidence_ids(a, b)


def _documents(t: Tables):
    return t.supplier.select(F.concat(F.lit("Brand#"), F.col("s_nationkey").cast("string")).alias("portal_id"), F.lit(3).alias("field_count"))


_COVER = f"""{m.REC}, {m.DOC}, d AS (SELECT record_id, count(*) AS n FROM doc GROUP BY 1),
  cov AS (SELECT portal_id, count(*) AS catalog_records, CAST(2 * count(*) AS BIGINT) AS declared_output_tokens, CAST(coalesce(sum(n), 0) AS BIGINT) AS documented_columns,
    count(n) AS records_with_documented_columns, count(*) - count(n) AS records_without_documented_columns, count(DISTINCT p_name || '/' || p_size) AS distinct_catalog_keys,
    count(DISTINCT p_size) AS provider_codes, coalesce((SELECT 3 * count(*) FROM supplier WHERE 'Brand#' || s_nationkey = portal_id), 0) AS fields_in_documents
    FROM rec LEFT JOIN d USING (record_id) GROUP BY 1)"""


def _coverage(t: Tables):
    rec = m.records(t)
    return cv.coverage_by_portal(rec, ct.declared_fields(rec), m.documented(t), _documents(t))


@query("q13_coverage_by_portal", f"WITH {_COVER} SELECT * FROM cov")
def coverage_by_portal(t: Tables):
    return _coverage(t)


@query("q142_coverage_total", f"""WITH {_COVER} SELECT count(*) AS portals, CAST(sum(catalog_records) AS BIGINT) AS catalog_records, CAST(sum(declared_output_tokens) AS BIGINT) AS declared_output_tokens,
  CAST(sum(documented_columns) AS BIGINT) AS documented_columns, CAST(sum(distinct_catalog_keys) AS BIGINT) AS distinct_catalog_keys, CAST(sum(provider_codes) AS BIGINT) AS provider_codes FROM cov""")
def coverage_total(t: Tables):
    return cv.coverage_total(_coverage(t)).select("portals", "catalog_records", "declared_output_tokens", "documented_columns", "distinct_catalog_keys", "provider_codes")


@query("q144_sufficiency", f"""WITH {_COVER} SELECT count(*) >= 20 AS portals, sum(documented_columns) > sum(catalog_records) AS columns, false AS unknown_kept, 'insufficient' AS decision FROM cov""")
def sufficiency(t: Tables):
    return cv.sufficiency_decision(cv.coverage_total(_coverage(t)), {
        "portals": F.col("portals") >= 20, "columns": F.col("documented_columns") > F.col("catalog_records"),
        "unknown_kept": F.lit(None).cast("boolean")})


@query("q143_provider_registry", f"""WITH {m.REC} SELECT portal_id, 'org-' || p_size AS provider_id, 'Provider ' || p_size AS name_as_reported, count(*) AS catalog_records FROM rec GROUP BY 1, 2, 3""")
def provider_registry(t: Tables):
    return cv.provider_registry(m.records(t)).drop("cross_portal_organization_identity")


@query("q16_presence_profile", """SELECT source, count(*) AS rows, count(*) FILTER (text <> '') AS with_text, count(*) FILTER (lang <> '') AS with_lang FROM documents GROUP BY 1""")
def presence_profile(t: Tables):
    return cv.presence_profile(t.documents, ["text", "lang"], ["source"])


@query("q145_max_distinct", """SELECT max(n) AS max_distinct FROM (SELECT count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY l_orderkey)""")
def max_distinct(t: Tables):
    return cv.max_distinct_per_group(t.lineitem, ["l_orderkey"], "l_suppkey")


@query("q48_queue_progress", """WITH tg AS (SELECT DISTINCT event_type AS q, user_id AS u FROM events), r AS (SELECT event_type AS q, user_id AS u, arg_max(CAST(event_id AS BIGINT), event_id) AS f FROM events WHERE value > 20 GROUP BY 1, 2)
  SELECT q AS queue, count(*) AS targets, count(f) AS processed, count(*) - count(f) AS remaining, CAST(coalesce(sum(f), 0) AS BIGINT) AS fields, count(*) = count(f) AS exhausted FROM tg LEFT JOIN r USING (q, u) GROUP BY 1""")
def queue_progress(t: Tables):
    e = t.events.select(F.col("event_type").alias("queue"), F.col("user_id").alias("target"), F.col("event_id").alias("seq"), "value", F.col("event_id").alias("fields"))
    return cv.queue_progress(e.select("queue", "target"), e.filter("value > 20").withColumn("status", F.lit("ok")))


@query("q146_pending", """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def pending(t: Tables):
    return cv.pending(t.customer.select("c_custkey"), t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("q147_upgrade_backlog", """SELECT doc_id, lang AS previous_status, 3 AS target_version FROM documents WHERE n_chars < 1500""")
def upgrade_backlog(t: Tables):
    d = t.documents.withColumn("parser_version", F.floor(F.col("n_chars") / 500).cast("int")).withColumn("status", F.col("lang"))
    return cv.upgrade_backlog(d, 3).select("doc_id", "previous_status", "target_version")


@query("q148_fold_occurrences", """SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, count(*) AS occurrences FROM orders GROUP BY 1""")
def fold_occurrences(t: Tables):
    return cv.fold_occurrences(t.orders, ["o_custkey"], ["o_orderkey"])[0].select("o_custkey", "o_orderpriority", "occurrences")


@query("q149_definition_periods", """SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS start_month, '' AS issue FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, 'P', 'invalid_stated_coverage_period' FROM orders WHERE o_orderstatus = 'P'""")
def definition_periods(t: Tables):
    day = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.lit("P"))
    ok, bad = cv.definition_periods(t.orders.withColumn("st", day).withColumn("en", day), "st", "en")
    return ok.select("o_orderkey", "start_month", F.lit("").alias("issue")).unionAll(bad.select("o_orderkey", "start_month", "issue"))


@query("q150_split_direction", """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'request' WHEN 'R' THEN CASE WHEN l_linestatus = 'O' THEN 'excluded' ELSE 'column' END ELSE 'unresolved' END AS part,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'generic_element_name' WHEN l_returnflag NOT IN ('A', 'R') THEN 'parameter_direction_missing' END AS reason FROM lineitem""")
def split_direction(t: Tables):
    return cv.split_direction(t.lineitem, "l_returnflag", "l_linestatus", "A", "R", ("o",)).select("l_orderkey", "l_linenumber", "part", "reason")


@query("q151_page_status", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'truncated' WHEN o_orderpriority = '5-LOW' THEN 'page_echo_mismatch' WHEN o_totalprice < 100000 THEN 'short_page' ELSE 'complete' END AS status,
  CASE WHEN o_orderstatus = 'F' THEN 'observed' ELSE 'table_identity_mismatch' END AS identity FROM orders""")
def page_status(t: Tables):
    rows = F.when(F.col("o_totalprice") < 100000, F.lit(10)).otherwise(F.lit(50))
    echo = F.when(F.col("o_orderpriority") != "5-LOW", F.lit(1))
    return t.orders.select("o_orderkey", cv.page_status(rows, F.lit(1), F.lit(9), 50, echo, F.col("o_orderstatus") != "P").alias("status"),
                           cv.identity_guard(F.lit("F"), F.col("o_orderstatus"), "table").alias("identity"))


@query("q152_precedence_merge", """SELECT p_partkey, CASE WHEN p_size > 20 THEN 'new' ELSE 'old' END AS origin FROM part WHERE p_size > 20 OR p_retailprice > 1000""")
def precedence_merge(t: Tables):
    new = t.part.filter("p_size > 20").select("p_partkey", F.lit("new").alias("origin"))
    old = t.part.filter("p_retailprice > 1000").select("p_partkey", F.lit("old").alias("origin"))
    return ct.precedence_merge(["p_partkey"], new, old)


@query("q159_first_nonempty_source", """SELECT o_custkey, coalesce(arg_min(o_orderpriority, o_orderkey) FILTER (o_orderstatus <> 'P'), arg_min(o_orderpriority, o_orderkey)) AS chosen FROM orders GROUP BY 1""")
def first_nonempty_source(t: Tables):
    o = t.orders.withColumn("is_empty", F.col("o_orderstatus") == "P")
    return jn.first_per_key(o, ["o_custkey"], ["is_empty", "o_orderkey"], ["o_orderpriority"]).withColumnRenamed("o_orderpriority", "chosen")


@query("q153_regional_coverage", """SELECT region, count(c) AS services, count(*) FILTER (c > 0) AS body_observed FROM (SELECT 'R' || r_regionkey AS region FROM region UNION ALL SELECT 'R' || n_regionkey || ' N' || n_nationkey FROM nation UNION ALL SELECT 'none') LEFT JOIN (
  SELECT 'R' || n_regionkey || ' N' || n_nationkey AS place, c_acctbal AS c FROM customer JOIN nation ON n_nationkey = c_nationkey) ON place = region OR starts_with(place, region || ' ') GROUP BY 1""")
def regional_coverage(t: Tables):
    place = F.concat(F.lit("R"), F.col("n_regionkey").cast("string"), F.lit(" N"), F.col("n_nationkey").cast("string"))
    s = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        place.alias("region"), F.when(F.col("c_acctbal") > 0, F.lit("body_observed")).otherwise(F.lit("title_only")).alias("observation_status"))
    regions = (t.region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("region"))
               .unionAll(t.nation.select(place)).unionAll(t.region.select(F.lit("none")).distinct()))
    return rg.regional_coverage(s, regions)


@query("q154_lifecycle", """SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'""")
def lifecycle(t: Tables):
    st = F.when(F.col("o_orderstatus") == "F", F.lit("production_ended")).when(F.col("o_orderstatus") == "O", F.lit("active"))
    return rg.current_only(t.orders.withColumn("lifecycle", st)).select("o_orderkey")


@query("q155_heading_scope", """WITH e AS (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos,
    CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 4 END AS level, l_linestatus || l_quantity::INT AS label FROM lineitem),
  s AS (SELECT *, last_value(CASE WHEN level = 3 THEN label END IGNORE NULLS) OVER w AS section, last_value(CASE WHEN level = 3 THEN pos END IGNORE NULLS) OVER w AS sp,
    last_value(CASE WHEN level = 4 THEN label END IGNORE NULLS) OVER w AS op, last_value(CASE WHEN level = 4 THEN pos END IGNORE NULLS) OVER w AS opos FROM e
    WINDOW w AS (PARTITION BY l_orderkey ORDER BY pos ROWS UNBOUNDED PRECEDING))
  SELECT l_orderkey, pos, section, CASE WHEN sp IS NULL OR opos > sp THEN op END AS operation FROM s""")
def heading_scope(t: Tables):
    place = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    e = t.lineitem.select("l_orderkey", *place,
                          F.when(F.col("l_returnflag") == "R", F.lit(3)).when(F.col("l_returnflag") == "A", F.lit(4)).alias("level"),
                          F.concat("l_linestatus", F.col("l_quantity").cast("int").cast("string")).alias("label"))
    return sc.heading_scope(e, "l_orderkey", place, "level", "label", number="pos").select("l_orderkey", "pos", "section", "operation")


@query("q156_institution_queue", """WITH p AS (SELECT o_orderkey, o_orderpriority AS lst, last_value(CASE WHEN o_orderstatus = 'P' THEN 'o' || o_orderkey END IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS parent FROM orders)
  SELECT 'gov24-' || c_custkey AS id, c_name AS name, 'directory-gov24' AS source, NULL AS parent_name FROM customer
  UNION ALL SELECT 'local-' || substr(sha256('u' || o_orderkey), 1, 12), 'o' || o_orderkey, 'directory-local', parent FROM p
  UNION ALL SELECT 'alio-' || s_suppkey, s_name, 'alio-roster', NULL FROM supplier""")
def institution_queue(t: Tables):
    gov = t.customer.select(F.col("c_custkey").cast("string").alias("value"), F.col("c_name").alias("text"), F.col("c_mktsegment").alias("group"))
    loc = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("lst"), "o_orderstatus", F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("label"),
                          F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("url"))
    loc = inst.carry_parent(loc, F.col("o_orderstatus") == "P", "label", "o_orderkey", "lst")
    alio = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.lit("").alias("type"), F.lit("h").alias("homepage"), F.lit(None).cast("string").alias("parent_name"))
    return inst.build_institution_queue(gov, loc, alio).select("id", "name", "source", "parent_name")


@query("q157_vocabulary", f"""WITH {m.REC}, {m.DOC}, {m.VOCAB} SELECT concept_id, ckind AS kind, alias FROM alias""")
def vocabulary(t: Tables):
    return m.vocabulary(t).aliases.select("concept_id", "kind", "alias")


@query("q174_vocabulary_relations", """WITH w AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS s, p_type FROM part),
  topic AS (SELECT s, min(p_type) AS tp FROM w GROUP BY 1)
  SELECT 'topic-membership:entitytype:' || s AS id, 'entitytype:' || s AS source, 'inTopic' AS predicate, 'topic:' || lower(tp) AS target FROM topic
  UNION ALL SELECT 'distinction:' || s || ':' || lower(tp), 'unit:' || s, 'distinguishFrom', 'topic:' || lower(tp) FROM topic""")
def vocabulary_relations(t: Tables):
    w = t.part.groupBy(F.split("p_name", " ")[1].alias("slug")).agg(F.min("p_type").alias("tp"))

    def rows(kind, topic):
        return w.select(F.lit(kind).alias("kind"), "slug", F.col("slug").alias("label"), topic.alias("topic"), F.col("slug").alias("aliases"), F.lit("").alias("scope_checks"))

    topics = w.select(F.lit("Topic").alias("kind"), F.lower("tp").alias("slug"), F.col("tp").alias("label"), F.lit(None).cast("string").alias("topic"), F.col("tp").alias("aliases"), F.lit("").alias("scope_checks")).distinct()
    v = vc.concept_vocabulary(topics.unionAll(rows("EntityType", F.lower("tp"))).unionAll(rows("Unit", F.lit(None).cast("string"))),
                              w.select(F.col("slug").alias("a"), F.lower("tp").alias("b")))
    return v.relationships.select("id", "source", "predicate", "target")


@query("q175_recompute_matches", f"""WITH {m.MATCH} SELECT count(*) AS stored, CAST(0 AS BIGINT) AS differences FROM mapped""")
def recompute_matches(t: Tables):
    """The stored items' concepts, mappings and aggregates against a recomputation by one exploded join over the source items."""
    store = m.graph(t)
    al = materialize(m.vocabulary(t).aliases.select("alias", "concept_id", F.col("kind").alias("ckind")).distinct(), "aliases")
    diff = store.source_differences(_matched_again(m.items(t), al)).agg(
        F.lit(0).cast("long").alias("stored"), F.count(F.lit(1)).alias("differences"))
    both = store.mappings.agg(F.count(F.lit(1)).alias("stored"), F.lit(0).cast("long").alias("differences")).unionByName(diff)
    return both.agg(F.sum("stored").alias("stored"), F.sum("differences").alias("differences"))


def _matched_again(items: DataFrame, al: DataFrame) -> DataFrame:
    """(item, record_id, portal_id, kind, concept_id) of every match by one exploded join.

    A concept counts once an item: what the second name or the rule finds is left out where a name before it found the same,
    so items are not shuffled to be made distinct.
    """
    field, label, other = F.col("kind") == "documented_field", F.col("label"), F.col("name_en")

    def place(by: str, alias: Column, given: Column) -> Column:
        return F.when(given & alias.isNotNull(), F.struct(F.lit(by).alias("by"), alias.alias("alias")))

    own = ["item", "record_id", "portal_id", "kind"]
    it = items.filter("not is_control").withColumn("item", gs.item_hash()).select(*own, "label", "name_en", F.inline(F.array_compact(F.array(
        place("label", label, F.lit(True)), place("name_en", other, ~other.eqNullSafe(label)), place("unit", F.col("unit"), field),
        place("rule", F.lit("measure:open"), field & (F.col("portal_id") == "Brand#2") & (other == "O"))))))
    named, fits = al.filter("ckind <> 'Unit'"), fits_broadcast(al)
    rule = al.sparkSession.range(1).select(F.lit("measure:open").alias("alias"), F.lit("measure:open").alias("concept_id"), F.lit("Measure").alias("ckind"))
    book = (named.crossJoin(al.sparkSession.createDataFrame([("label",), ("name_en",)], "by string"))
            .unionByName(al.filter("ckind = 'Unit'").withColumn("by", F.lit("unit"))).unionByName(rule.withColumn("by", F.lit("rule"))))
    hits = dictionary_join(it, book, ["by", "alias"], fits=fits).filter("kind = 'catalog_label' or ckind <> 'Topic'").filter(
        "not (concept_id = 'dimension:small' and label = 'small' and portal_id <> 'Brand#1')").drop("alias", "ckind")
    for name in ("label", "name_en"):
        found = named.select(F.col("alias").alias(name), "concept_id").distinct().withColumn(f"_{name}", F.lit(True))
        hits = dictionary_join(hits, found, [name, "concept_id"], "left", fits=fits)
    first = F.when(F.col("by") == "name_en", F.col("_label").isNull()).when(
        F.col("by") == "rule", F.col("_label").isNull() & F.col("_name_en").isNull()).otherwise(True)
    return hits.filter(first).select(*own, "concept_id")
