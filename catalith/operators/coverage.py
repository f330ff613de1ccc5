"""Coverage, presence and progress aggregates over the catalogue tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(c: str) -> Column:
    """True when the text is neither null nor empty."""
    return F.coalesce(F.col(c).cast("string"), F.lit("")) != ""


def coverage_by_portal(records: DataFrame, tokens: DataFrame, documented: DataFrame, documents: DataFrame) -> DataFrame:
    """Registrations, keys, providers, tokens and documented columns per portal.

    Children are counted per registration before they meet the portal, so the
    portal groups only see one row per registration.
    """
    tok = tokens.filter("role = 'output'").groupBy("record_id").agg(F.count(F.lit(1)).alias("_t"))
    doc = documented.groupBy("record_id").agg(F.count(F.lit(1)).alias("_d"))
    r = (records.select(F.col("id").alias("record_id"), "portal_id", "dataset_key", "provider_id")
         .join(tok, "record_id", "left").join(doc, "record_id", "left"))
    main = r.groupBy("portal_id").agg(
        F.count(F.lit(1)).alias("catalog_records"),
        F.coalesce(F.sum("_t"), F.lit(0)).alias("declared_output_tokens"),
        F.coalesce(F.sum("_d"), F.lit(0)).alias("documented_columns"),
        F.count("_d").alias("records_with_documented_columns"),
        F.count_if(F.col("_d").isNull()).alias("records_without_documented_columns"))
    keys = records.select("portal_id", "dataset_key").distinct().groupBy("portal_id").agg(
        F.count("dataset_key").alias("distinct_catalog_keys"))
    prov = records.select("portal_id", "provider_id").distinct().groupBy("portal_id").agg(
        F.count("provider_id").alias("provider_codes"))
    docs = documents.groupBy("portal_id").agg(F.coalesce(F.sum("field_count"), F.lit(0)).alias("fields_in_documents"))
    out = main.join(keys, "portal_id").join(prov, "portal_id").join(docs, "portal_id", "left")
    return out.withColumn("fields_in_documents", F.coalesce("fields_in_documents", F.lit(0)).cast("long"))


def coverage_total(by_portal: DataFrame) -> DataFrame:
    """Sums over portals; keys are summed per portal namespace, never merged."""
    cols = [c for c in by_portal.columns if c != "portal_id"]
    return by_portal.agg(F.count(F.lit(1)).alias("portals"), *[F.sum(c).cast("long").alias(c) for c in cols])


def provider_registry(records: DataFrame) -> DataFrame:
    """Providers of each portal's own namespace with a reported name and a count."""
    return records.filter("provider_id is not null").groupBy("portal_id", "provider_id").agg(
        F.min("provider_name").alias("name_as_reported"), F.count(F.lit(1)).alias("catalog_records")).withColumn(
        "cross_portal_organization_identity", F.lit("not_reconciled"))


def presence_profile(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """How many rows have a non-empty value in each column."""
    aggs = [F.count(F.lit(1)).alias("rows"), *[F.count_if(present(c)).alias(f"with_{c}") for c in columns]]
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


def sufficiency_decision(summary: DataFrame, criteria: dict[str, Column]) -> DataFrame:
    """Evaluate named criteria over a one-row summary and decide.

    A criterion that cannot be computed counts as not met.
    """
    out = summary.select(*[F.coalesce(c, F.lit(False)).alias(k) for k, c in criteria.items()])
    every = F.lit(True)
    for k in criteria:
        every = every & F.col(k)
    return out.withColumn("decision", F.when(every, F.lit("sufficient_for_prototype_scope"))
                          .otherwise(F.lit("insufficient")))


def max_distinct_per_group(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Largest number of distinct values any group has."""
    per = df.select(*group, value).distinct().groupBy(*group).agg(F.count(value).alias("n"))
    return per.agg(F.max("n").alias("max_distinct"))


def queue_progress(targets: DataFrame, results: DataFrame) -> DataFrame:
    """Target, processed and remaining counts of each queue, and whether it is done.

    ``targets(queue, target)``; ``results(queue, target, status, fields)`` may
    repeat a target, the last result (by ``seq``) counts.
    """
    last = results.groupBy("queue", "target").agg(F.max_by(F.struct("status", "fields"), "seq").alias("_r"))
    j = targets.distinct().join(last, ["queue", "target"], "left")
    done = F.col("_r").isNotNull()
    return j.groupBy("queue").agg(
        F.count(F.lit(1)).alias("targets"), F.count_if(done).alias("processed"),
        F.count_if(~done).alias("remaining"), F.coalesce(F.sum("_r.fields"), F.lit(0)).alias("fields")).withColumn(
        "exhausted", F.col("remaining") == 0)


def status_histogram(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def pending(targets: DataFrame, results: DataFrame, key: Sequence[str]) -> DataFrame:
    """Targets that have no result yet (resume point)."""
    return targets.join(results.select(*key).distinct(), list(key), "left_anti")


def upgrade_backlog(documents: DataFrame, version: int) -> DataFrame:
    """Cached documents parsed by an older parser, with their previous outcome."""
    old = F.coalesce("parser_version", F.lit(0)) < version
    return documents.filter(old).withColumn("previous_status", F.col("status")).withColumn(
        "target_version", F.lit(version))


def relationship_evidence(records: DataFrame, documented: DataFrame) -> DataFrame:
    """Registration, provider and field relations with their real evidence level."""
    lists = records.select(F.col("portal_id").alias("source"), F.lit("listsRegistration").alias("predicate"),
                           F.col("id").alias("target"), "evidence_id", F.lit("source_catalog_observed").alias("status"))
    prov = records.filter("provider_id is not null").select(
        F.col("id").alias("source"), F.lit("reportedProvider").alias("predicate"), F.col("provider_id").alias("target"),
        "evidence_id", F.lit("provider_reported_in_catalog").alias("status"))
    field = documented.select(
        F.col("record_id").alias("source"), F.lit("hasDocumentedField").alias("predicate"),
        F.concat_ws(":", "record_id", F.col("ordinal").cast("string")).alias("target"), "evidence_id",
        F.lit("definition_observed_not_data_validated").alias("status"))
    return lists.unionAll(prov).unionAll(field)


def documented_split(records: DataFrame, documented: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(with, without): registrations that have, and lack, formal columns."""
    ids = documented.select(F.col("record_id").alias("id"))
    return records.join(ids, "id", "left_semi"), records.join(ids, "id", "left_anti")


def fold_occurrences(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(registrations, occurrences): one registration per key and every source row.

    The first occurrence describes the registration; all rows stay as children,
    keyed, so a key with very many source rows is not gathered into one value.
    """
    rest = [c for c in df.columns if c not in keys]
    reg = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_f"),
                                F.count(F.lit(1)).alias("occurrences")).select(*keys, "_f.*", "occurrences")
    return reg, df.select(*keys, *rest)


def definition_periods(df: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """(rows, issues): months cut from stated coverage days; bad periods are issues."""
    s, e = F.substring(start, 1, 6), F.substring(end, 1, 6)
    ok = F.coalesce(s.rlike("^[0-9]{6}$") & e.rlike("^[0-9]{6}$"), F.lit(False))
    tagged = df.withColumn("start_month", s).withColumn("end_month", e).withColumn("_ok", ok)
    return (tagged.filter("_ok").drop("_ok"),
            tagged.filter("not _ok").drop("_ok").withColumn("issue", F.lit("invalid_stated_coverage_period")))


def split_direction(params: DataFrame, direction: str, name: str, request: str, response: str,
                    generic: tuple[str, ...]) -> DataFrame:
    """Label each parameter row request, column or excluded (with the reason).

    A response element with a container-like generic name is kept but not
    counted as a column.
    """
    is_req, is_res = F.col(direction) == request, F.col(direction) == response
    vague = F.lower(name).isin(*generic)
    return params.withColumn("part", F.when(is_req, F.lit("request")).when(is_res & vague, F.lit("excluded"))
                             .when(is_res, F.lit("column")).otherwise(F.lit("unresolved"))).withColumn(
        "reason", F.when(is_res & vague, F.lit("generic_element_name")).when(
            ~(is_req | is_res), F.lit("parameter_direction_missing")))


def identity_guard(requested: Column, observed: Column, what: str) -> Column:
    """``observed`` when the response names the requested object, else a mismatch status."""
    return F.when(F.coalesce(requested == observed, F.lit(False)), F.lit("observed")).otherwise(
        F.lit(f"{what}_identity_mismatch"))


def page_status(rows: Column, page_no: Column, pages: Column, size: int, echoed: Column, closed: Column) -> Column:
    """Completeness of one listing page: closed markup, page echo, full row count."""
    return (F.when(~F.coalesce(closed, F.lit(False)), F.lit("truncated"))
            .when(~F.coalesce(echoed == page_no, F.lit(False)), F.lit("page_echo_mismatch"))
            .when((page_no < pages) & (rows != size), F.lit("short_page"))
            .otherwise(F.lit("complete")))
