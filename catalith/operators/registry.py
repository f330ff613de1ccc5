"""Portal registry: page observations, navigation leads, referrals, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.functions.text import lead_id
from catalith.functions.url import host, hostname, reference_kind, stable_url
from catalith.layout import dense_row_number, dictionary_join, rank_within

# Patterns and stop titles of the registry's classifiers.
NAVIGATION = "(?i)공공\\s*데이터|데이터셋|데이터\\s*(?:검색|목록|제공)|OPEN\\s*API|오픈\\s*API|개발자|이용안내|이용약관|저작권"
NOTICE = "공지|설문|당첨|이벤트|경진대회|공모전|활용사례|개방요청|제공신청|채용|입찰|보도"
SITE_SCAN = "(?i)공공\\s*데이터|데이터\\s*(?:개방|포털|허브|플랫폼)|오픈\\s*API|OPEN[ -]?API|통계\\s*(?:정보|포털)|데이터셋"
INTERSTITIAL = "(?i)접속 확인|접근 차단|Access Denied|maintenance|/Auth\\.do"
STOP_TITLES = ("index", "init-page", "메인")
BODY_CHARS = 200
LABEL_CHARS = {"navigation": 200, "scan": 180, "referral": 240}
MAX_NAVIGATION = 24


def observation_status(status: Column, title: Column, final_url: Column, text: Column) -> Column:
    """How much of a fetched page was really seen."""
    t = F.coalesce(title, F.lit(""))
    return (F.when(~F.coalesce(status == "page_observed", F.lit(False)), F.lit("fetch_unresolved"))
            .when(F.concat(t, F.lit(" "), F.coalesce(final_url, F.lit(""))).rlike(INTERSTITIAL),
                  F.lit("interstitial_observed"))
            .when(F.length(F.coalesce(text, F.lit(""))) >= BODY_CHARS, F.lit("body_observed"))
            .when((t != "") & ~F.lower(t).isin(*STOP_TITLES), F.lit("title_only"))
            .otherwise(F.lit("response_only")))


def next_action(is_entrypoint: Column, status: Column, navigation: Column) -> Column:
    """What a researcher does next with a service; ``navigation`` is its link count."""
    return (F.when(is_entrypoint, F.lit("find_actual_data_list_on_institution_site"))
            .when(status != "body_observed", F.lit("recheck_official_guide_and_current_route"))
            .when(navigation > 0, F.lit("check_full_list_route_and_access_terms"))
            .otherwise(F.lit("find_access_route_of_list_or_api_docs")))


def is_navigation(label: Column, include: str = NAVIGATION, exclude: str = NOTICE) -> Column:
    return label.rlike(include) & ~label.rlike(exclude)


def navigation_candidates(links: DataFrame, service: str, page_url: str, url: str, label: str, position: str,
                          include: str = NAVIGATION, exclude: str = NOTICE, limit: int | None = None,
                          label_chars: int | None = None) -> DataFrame:
    """Same-host data links of each service page, one per URL, with rank and whole label.

    The place of a URL is its first occurrence and the label its last, as a later
    repeat of a link replaces the earlier text.  ``limit`` keeps the first links of a
    service, ``label_chars`` shortens the labels; both are for display.
    """
    keep = links.filter((host(url) == host(page_url)) & is_navigation(F.col(label), include, exclude))
    per = keep.groupBy(service, stable_url(url).alias("url")).agg(
        F.min(position).alias("first_position"),
        F.max_by(label, position).alias("label"))
    if label_chars is not None:
        per = per.withColumn("label", F.substring("label", 1, label_chars))
    if limit is None:
        ranked = rank_within(per, service, ["first_position", "url"])
    else:
        w = Window.partitionBy(service).orderBy("first_position")
        ranked = per.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
    return ranked.withColumn("status", F.lit("link_observed_target_not_tested"))


def navigation_display(links: DataFrame, service: str, page_url: str, url: str, label: str, position: str,
                       include: str = NAVIGATION, exclude: str = NOTICE) -> DataFrame:
    """The navigation candidates a service's page shows: the first ``MAX_NAVIGATION``, with shortened labels."""
    return navigation_candidates(links, service, page_url, url, label, position, include, exclude,
                                 MAX_NAVIGATION, LABEL_CHARS["navigation"])


def lead_merge(candidates: DataFrame, url: str, label: str, page: str, exclude: str = NOTICE) -> DataFrame:
    """One lead per URL with counts of its labels and pages, in no order (see ``review_queue``).

    ``likely_notice`` holds only when every label is a notice label.  The label
    and evidence lists stay in ``lead_members`` so that a link on every page of
    the web is still one small row here.
    """
    rows = candidates.select(stable_url(url).alias("url"), F.col(label).alias("label"), F.col(page).alias("page"))
    return rows.groupBy("url").agg(
        F.count_distinct("label").alias("labels"), F.count_distinct("page").alias("pages"),
        F.min("label").alias("first_label"), F.bool_and(F.col("label").rlike(exclude)).alias("likely_notice")).select(
        lead_id("url").alias("id"), "url", "labels", "pages", "first_label", "likely_notice",
        F.lit("navigation_candidate").alias("status"))


def review_queue(leads: DataFrame) -> DataFrame:
    """Adds ``place``, the lead's number in the review queue: notices last, then by URL.

    A lead without any known label counts as no notice.
    """
    late = F.coalesce("likely_notice", F.lit(False))
    return dense_row_number(leads, [late, "url"], "place")


def service_hosts(services: DataFrame, service: str, requested_url: str, final_url: str) -> DataFrame:
    """Distinct (target_host, service_id): a service answers at the host it was asked at and at the one it led to."""
    at = services.select(F.explode(F.array_distinct(F.array(
        host(requested_url), host(F.coalesce(final_url, requested_url))))).alias("target_host"), F.col(service).alias("service_id"))
    return at.filter(F.col("target_host") != "").distinct()


def lead_services(leads: DataFrame, hosts: DataFrame) -> DataFrame:
    """Leads with their host, the number of known services there and the first of them.

    ``hosts`` is the result of ``service_hosts`` and keeps the whole lists: a lead reads its services through its
    host, so the pairs lead x service are never written out.
    """
    per = hosts.groupBy("target_host").agg(F.count("service_id").alias("services"), F.min("service_id").alias("first_service"))
    out = dictionary_join(leads.withColumn("target_host", host("url")), per, ["target_host"], "left")
    return out.withColumn("services", F.coalesce("services", F.lit(0)).cast("long"))


def lead_members(candidates: DataFrame, url: str, label: str, page: str) -> DataFrame:
    """Distinct (lead, label, page) rows behind the leads."""
    return candidates.select(lead_id(stable_url(url)).alias("id"), F.col(label).alias("label"),
                             F.col(page).alias("page")).distinct()


def host_referrals(links: DataFrame, source: str, source_url: str, url: str, label: str, position: str,
                   label_chars: int | None = None) -> DataFrame:
    """First link from each source page to each other host, with its whole label (``label_chars`` shortens it for display).

    One row per (target host, source).  Services read their referrals through
    their host, so the pairs service x source are never written out.
    """
    text = F.col(label) if label_chars is None else F.substring(label, 1, label_chars)
    rows = links.select(
        host(url).alias("target_host"), F.col(source).alias("source"), host(source_url).alias("source_host"),
        F.struct(F.col(position).alias("position"), stable_url(url).alias("link_url"),
                 text.alias("link_label")).alias("_l"))
    rows = rows.filter((F.col("target_host") != "") & (F.col("target_host") != F.col("source_host")))
    return rows.groupBy("target_host", "source", "source_host").agg(F.min("_l").alias("_l")).select(
        "target_host", "source", "source_host", "_l.link_url", "_l.link_label")


def referral_counts(services: DataFrame, referrals: DataFrame, url: str) -> DataFrame:
    """Services with the number of pages on other hosts that link to their host."""
    per_host = referrals.groupBy("target_host").agg(F.count(F.lit(1)).alias("_n"))
    out = services.withColumn("target_host", host(url)).join(per_host, "target_host", "left")
    return out.withColumn("referral_pages", F.coalesce("_n", F.lit(0)).cast("long")).drop("_n")


def external_references(links: DataFrame, url: str) -> DataFrame:
    """Links to http(s) pages with host and kind (licence page or not)."""
    return links.withColumn("target_host", hostname(url)).withColumn("reference_kind", reference_kind(url)).filter(
        F.col("reference_kind").isNotNull())


def host_frontier(references: DataFrame, portals: DataFrame) -> DataFrame:
    """References per non-licence host with a known-portal flag.

    ``portals(portal_id, requested_url, final_url)``.
    """
    counts = references.filter("reference_kind <> 'license_reference'").groupBy("target_host").agg(
        F.count(F.lit(1)).alias("observed_reference_count"))
    known = portals.select(F.explode(F.array("requested_url", "final_url")).alias("u"), "portal_id").select(
        hostname("u").alias("target_host"), "portal_id").filter("target_host is not null").groupBy("target_host").agg(
        F.count_distinct("portal_id").alias("registered_portals"))
    out = dictionary_join(counts, known, ["target_host"], "left")
    is_known = F.col("registered_portals").isNotNull()
    return out.select(
        F.col("target_host").alias("host"), "observed_reference_count",
        F.coalesce("registered_portals", F.lit(0)).cast("long").alias("registered_portals"),
        F.when(is_known, F.lit("target_dataset_mapping_pending"))
        .otherwise(F.lit("domestic_public_provider_classification_pending")).alias("status"))


def regional_coverage(services: DataFrame, regions: DataFrame, region: str = "region") -> DataFrame:
    """Services and observed bodies per region: the region itself or a place inside it.

    A service counts for every region that equals its region text or is a
    prefix ending at a space, so its text is unfolded into those prefixes and
    joined by equality; regions without services stay with zero.
    """
    words = F.split(F.col(region), " ")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, 1, n), " "))
    s = services.select(F.explode(F.array_distinct(prefixes)).alias(region), "observation_status")
    per = s.groupBy(region).agg(F.count(F.lit(1)).alias("services"),
                                F.count_if(F.col("observation_status") == "body_observed").alias("body_observed"))
    return regions.join(per, region, "left").na.fill(0, ["services", "body_observed"])


def registry_summary(services: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Long histogram (facet, value, services) over the given columns in one pass."""
    facets = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in by]))
    return services.select(facets.alias("f")).groupBy(F.col("f.facet").alias("facet"), F.col("f.value").alias("value")).agg(
        F.count(F.lit(1)).alias("services"))


def current_only(datasets: DataFrame) -> DataFrame:
    """Leave out datasets whose production has ended; unknown lifecycle stays."""
    return datasets.filter(~F.coalesce(F.col("lifecycle") == "production_ended", F.lit(False)))
