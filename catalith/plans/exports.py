"""Queries over shards, receipts, histories and summary documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.operators import lexical as lx
from catalith.plans import model as m
from catalith.plans.registry import Tables, query
from catalith.sinks import export as xp
from catalith.streaming import incremental as ic


def _sharded(t: Tables, rows: int = 500):
    p = t.part.select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("record_id"), F.col("p_partkey"),
                      F.col("p_brand").alias("portal_id"), F.col("p_type").alias("kind"),
                      F.when(F.col("p_size") > 10, F.split("p_name", " ")).otherwise(F.array().cast("array<string>")).alias("concept_ids"))
    return xp.with_shards(p, ["p_partkey"], rows)


_SHARD = """s AS (SELECT *, CAST((row_number() OVER (ORDER BY p_partkey) - 1) // 500 AS INTEGER) AS shard, 'part-' || p_partkey AS record_id FROM part),
  st AS (SELECT shard, p_brand AS portal_id, p_type AS kind, count(*) AS rows, count(*) FILTER (p_size > 10) AS mapped_rows, min(record_id) AS first_record, max(record_id) AS last_record FROM s GROUP BY ALL)"""


@query("q46_shard_stats", f"WITH {_SHARD} SELECT * FROM st")
def shard_stats(t: Tables):
    return xp.shard_stats(_sharded(t))


@query("q176_shard_concepts", f"""WITH {_SHARD} SELECT shard, portal_id, kind, concept_id, count(*) AS occurrences FROM (
    SELECT shard, p_brand AS portal_id, p_type AS kind, unnest(string_split(p_name, ' ')) AS concept_id FROM s WHERE p_size > 10) GROUP BY ALL""")
def shard_concepts(t: Tables):
    return xp.shard_concepts(_sharded(t))


@query("q47_shard_skip", f"""WITH {_SHARD}, p AS (SELECT shard, CAST(sum(mapped_rows) AS BIGINT) AS matches FROM st WHERE portal_id = 'Brand#3' GROUP BY 1 HAVING sum(mapped_rows) > 0),
  c AS (SELECT *, CAST(coalesce(sum(matches) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM p)
  SELECT shard, matches, before FROM c WHERE before < 24 AND before + matches > 0""")
def shard_skip(t: Tables):
    stats = xp.shard_stats(_sharded(t))
    return xp.shards_for_page(stats, F.when(F.col("portal_id") == "Brand#3", F.col("mapped_rows")).otherwise(F.lit(0)), 1, 24)


@query("q160_shard_manifest", """WITH s AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS r FROM lineitem)
  SELECT CAST((r - 1) // 5000 AS INTEGER) AS shard, count(*) AS rows, arg_min(l_orderkey, r) AS first, arg_max(l_orderkey, r) AS last,
    sha256(string_agg('{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}', chr(10) ORDER BY r)) AS sha256 FROM s GROUP BY 1""")
def shard_manifest(t: Tables):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    return xp.shard_manifest(xp.with_shards(t.lineitem.select(*keys), keys), "l_orderkey", ["l_orderkey", "l_linenumber"])


@query("q161_receipt_buckets", """SELECT substr(sha256('order-' || o_orderkey), 1, 2) AS bucket, count(*) AS receipts FROM orders GROUP BY 1""")
def receipt_buckets(t: Tables):
    o = t.orders.select(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("id"))
    return o.groupBy(xp.receipt_bucket("id").alias("bucket")).agg(F.count(F.lit(1)).alias("receipts"))


@query("q162_redacted_count", """SELECT count(*) FILTER (p_size > 10) AS redacted_url_parameters FROM part""")
def redacted_count(t: Tables):
    p = t.part.select(F.concat(F.lit("https://x/?key="), F.when(F.col("p_size") > 10, F.col("p_brand")).otherwise(F.lit(""))).alias("url"))
    _, n = xp.redact_columns(p, ["url"])
    return p.agg(n)


@query("q163_overview", f"""WITH {m.MATCH}, pc AS (SELECT DISTINCT portal_id, concept_id, kind FROM mapped)
  SELECT (SELECT count(*) FROM items) AS source_items, (SELECT count(DISTINCT portal_id) FROM rec) AS portals, (SELECT count(DISTINCT concept_id) FROM alias) AS concepts,
    (SELECT count(*) FROM pc) AS edges, (SELECT count(DISTINCT (portal_id, concept_id)) FROM pc) AS pairs, (SELECT count(*) FROM pc WHERE kind = 'catalog_label') AS label_edges""")
def overview(t: Tables):
    matched = m.matched(t)
    v = m.vocabulary(t)
    doc = F.parse_json("overview")
    o = xp.overview(lx.graph_counts(matched), t.part.select("p_brand").distinct(), v.concepts, lx.portal_concepts(matched), all_matches_indexed=True)

    def n(path):
        return F.try_variant_get(doc, path, "long")

    return o.select(n("$.counts.source_items").alias("source_items"), n("$.sizes.portals").alias("portals"), n("$.sizes.concepts").alias("concepts"),
                    n("$.sizes.edges").alias("edges"), n("$.sizes.portal_concept_pairs").alias("pairs"), n("$.edges_by_kind.catalog_label").alias("label_edges"))


_LOG = """lg AS (SELECT o_orderkey, 1 AS batch, o_orderstatus AS st FROM orders WHERE o_totalprice > 50000 UNION ALL SELECT o_orderkey, 2, o_orderpriority FROM orders WHERE o_totalprice < 200000)"""


def _log(t: Tables):
    return t.orders.filter("o_totalprice > 50000").select("o_orderkey", F.lit(1).alias("batch"), F.col("o_orderstatus").alias("st")).unionAll(
        t.orders.filter("o_totalprice < 200000").select("o_orderkey", F.lit(2).alias("batch"), F.col("o_orderpriority").alias("st")))


@query("q49_upsert_history", f"WITH {_LOG} SELECT o_orderkey, arg_max(st, batch) AS st, max(batch) AS batch, count(*) AS versions FROM lg GROUP BY 1")
def upsert_history(t: Tables):
    return ic.upsert_view(_log(t), ["o_orderkey"], ["batch"])


@query("q177_history_flags", f"WITH {_LOG} SELECT o_orderkey, min(batch) AS first_batch, max(batch) AS last_batch, max(batch) < 2 AS kept_as_history FROM lg GROUP BY 1")
def history_flags(t: Tables):
    return ic.history_flags(_log(t), ["o_orderkey"], "batch")


@query("q164_supersede", """WITH v AS (SELECT l_orderkey AS key, l_linenumber - 1 AS pos, l_returnflag <> 'N' AS ok, l_linestatus AS d FROM lineitem), seen AS (SELECT DISTINCT key FROM v WHERE pos = 0 AND ok)
  SELECT key, d AS definition, 'current' AS origin FROM v SEMI JOIN seen USING (key) WHERE ok
  UNION ALL SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey IN (SELECT key FROM seen) THEN 'replaced' ELSE 'current' END FROM orders""")
def supersede(t: Tables):
    v = t.lineitem.select(F.col("l_orderkey").alias("key"), (F.col("l_linenumber") - 1).alias("pos"), F.col("l_linestatus").alias("definition"),
                          F.when(F.col("l_returnflag") != "N", F.lit("column_definition_observed")).otherwise(F.lit("x")).alias("status"))
    return ic.supersede_if_default_seen(v, t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("definition")))


@query("q165_retain", """SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAY""")
def retain(t: Tables):
    return ic.retain(t.events, "ts", 10, "2024-01-31 00:00:00").select("event_id")
