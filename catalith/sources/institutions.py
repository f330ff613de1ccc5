"""Institution rosters and the canonical sites behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.text import short_hash, site_id
from catalith.functions.url import hostname, site_key
from catalith.operators.scan import carry_down


def page_snapshot(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Already fetched landing pages as (id, requested_url, status, html)."""
    body = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.col(key).alias("id"), F.col("url").alias("requested_url"),
        F.when(body != "", F.lit("page_observed")).otherwise(F.lit("fetch_unresolved")).alias("status"),
        "html")


def dedupe_targets(institutions: DataFrame, key: str = "id", homepage: str = "homepage") -> tuple[DataFrame, DataFrame]:
    """(targets, members): one row per canonical site and one per (site, institution).

    A homepage without a scheme is read as https and marked ``scheme_assumed``.
    Text that cannot be an address is left out.  The members stay a table of
    their own, so that a site shared by very many institutions is never gathered
    into one row; the target keeps their number and its first address.
    """
    addr = F.trim(F.col(homepage))
    assumed = ~addr.rlike("^https?://")
    full = F.when(assumed, F.concat(F.lit("https://"), addr)).otherwise(addr)
    rows = (institutions.filter(F.coalesce(addr, F.lit("")) != "")
            .select(F.col(key).alias("institution_id"), full.alias("url"), assumed.alias("scheme_assumed"))
            .filter(~F.col("url").rlike("[<> \\n]") & hostname("url").isNotNull())
            .withColumn("site_key", site_key("url")))
    first = F.struct("institution_id", "url", "scheme_assumed")
    targets = rows.groupBy("site_key").agg(F.min(first).alias("_f"), F.count(F.lit(1)).alias("institutions")).select(
        site_id("site_key").alias("id"), "site_key", F.col("_f.url").alias("url"),
        F.col("_f.scheme_assumed").alias("scheme_assumed"), "institutions")
    members = rows.select(site_id("site_key").alias("id"), "institution_id")
    return targets, members


def carry_parent(roster: DataFrame, is_parent: Column, label: str, position: str, block: str) -> DataFrame:
    """Give each roster row the latest parent label at or above it in its list."""
    return carry_down(roster, block, [position], F.when(is_parent, F.col(label)), "parent_name")


def build_institution_queue(gov: DataFrame, local: DataFrame, alio: DataFrame) -> DataFrame:
    """Union of three rosters in one queue; institutions are not merged across rosters.

    ``gov(value, text, group)``, ``local(url, label, parent_name)`` and
    ``alio(id, name, type, homepage, parent_name)``.
    """
    g = gov.filter(~F.coalesce("value", F.lit("")).isin("", "ALL")).select(
        F.concat(F.lit("gov24-"), "value").alias("id"), F.col("text").alias("name"),
        F.col("group").alias("category"), F.col("value").alias("source_identifier"),
        F.lit("directory-gov24").alias("source"))
    # A site listed twice keeps its first entry (by ``position`` when given).
    place = [c for c in ("position", "label", "parent_name") if c in local.columns]
    firsts = local.groupBy("url").agg(F.min(F.struct(*place)).alias("_f")).select("url", "_f.label", "_f.parent_name")
    lo = firsts.select(
        short_hash("local", "url").alias("id"), F.col("label").alias("name"),
        F.when(F.col("label") == F.col("parent_name"), F.lit("regional_site")).otherwise(
            F.lit("local_site")).alias("category"),
        F.lit(None).cast("string").alias("source_identifier"), F.lit("directory-local").alias("source"),
        F.col("url").alias("homepage"), "parent_name")
    a = alio.select(
        F.concat(F.lit("alio-"), "id").alias("id"), "name",
        F.concat(F.lit("ALIO "), F.coalesce(F.nullif("type", F.lit("")), F.lit("unclassified"))).alias("category"),
        F.col("id").alias("source_identifier"), F.lit("alio-roster").alias("source"), "homepage", "parent_name")
    return (g.unionByName(lo, allowMissingColumns=True).unionByName(a, allowMissingColumns=True)
            .withColumn("data_service_review_status", F.lit("not_reviewed")))
