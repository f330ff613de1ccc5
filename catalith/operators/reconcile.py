"""Reconciliation of every count, hash and order against its source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.layout import set_digest


def quarantine_split(rows: DataFrame, row_no: str, valid: Column, block: Sequence[str] = ()) -> DataFrame:
    """Add ``quarantine_reason``: malformed rows and the row a malformed run follows.

    A malformed line may continue the record before it, so the last valid row
    before a run is implicated too.  Row numbers are dense from 1 inside a block;
    the header (row 0) is never implicated.  The implicated rows are found by an
    equality join on the neighbour's number, not by an ordered window.
    """
    tagged = rows.withColumn("_ok", F.coalesce(valid, F.lit(False)))
    before = tagged.filter("not _ok").select(
        *block, (F.col(row_no) - 1).alias(row_no), F.lit(True).alias("_next_bad"))
    j = tagged.join(before, [*block, row_no], "left")
    reason = F.when(~F.col("_ok"), F.lit("invalid_record_shape_or_identifiers")).when(
        F.col("_next_bad"), F.lit("followed_by_malformed_continuation"))
    return j.withColumn("quarantine_reason", reason).drop("_ok", "_next_bad")


def accounting_identity(split: DataFrame, advertised: Column | None = None, group: Sequence[str] = ()) -> DataFrame:
    """source rows = imported + invalid + implicated; the advertised total stays visible."""
    r = F.col("quarantine_reason")
    aggs = [F.count(F.lit(1)).alias("source_rows"), F.count_if(r.isNull()).alias("imported"),
            F.count_if(r == "invalid_record_shape_or_identifiers").alias("invalid"),
            F.count_if(r == "followed_by_malformed_continuation").alias("implicated")]
    out = split.groupBy(*group).agg(*aggs) if group else split.agg(*aggs)
    out = out.withColumn("balanced", F.col("source_rows") == F.col("imported") + F.col("invalid") + F.col("implicated"))
    return out if advertised is None else out.withColumn("advertised_rows", advertised).withColumn(
        "advertised_count_matches", F.col("source_rows") == F.col("advertised_rows"))


def pagination_report(listing: DataFrame, portal: str, page: str, total: str, record: str, ok: str) -> DataFrame:
    """Received, unique and duplicate records, reported totals and completeness.

    ``complete`` needs one reported total, no failed page and as many unique
    records as reported.  Records are reduced per (portal, record) first.
    """
    per_page = listing.groupBy(portal, page).agg(F.bool_and(ok).alias("_ok"), F.min(total).alias("_lo"),
                                                 F.max(total).alias("_hi"))
    pages = per_page.groupBy(portal).agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(~F.col("_ok")).alias("failed_pages"),
        F.min("_lo").alias("reported_total_min"), F.max("_hi").alias("reported_total_max"))
    per_record = listing.filter(F.col(record).isNotNull()).groupBy(portal, record).agg(F.count(F.lit(1)).alias("_n"))
    rec = per_record.groupBy(portal).agg(F.sum("_n").alias("received"), F.count(F.lit(1)).alias("unique_records"))
    out = pages.join(rec, portal, "left").na.fill(0, ["received", "unique_records"])
    return out.withColumn("duplicates", F.col("received") - F.col("unique_records")).withColumn(
        "complete", (F.col("failed_pages") == 0) & (F.col("reported_total_min") == F.col("reported_total_max"))
        & (F.col("unique_records") == F.col("reported_total_min")))


def verify_hashes(evidence: DataFrame, content: str, sha: str, size: str) -> DataFrame:
    """Rows whose recomputed SHA-256 or byte length differs from the receipt."""
    body = F.col(content).cast("binary")
    return evidence.withColumn("actual_sha256", F.sha2(body, 256)).withColumn(
        "actual_bytes", F.octet_length(body).cast("long")).filter(
        ~F.col("actual_sha256").eqNullSafe(F.col(sha)) | ~F.col("actual_bytes").eqNullSafe(F.col(size).cast("long")))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def broken_references(relations: DataFrame, nodes: DataFrame, evidence: DataFrame) -> DataFrame:
    """(relation, problem): unknown endpoints, missing or unknown evidence."""
    ends = relations.select("id", F.inline(F.array(
        F.struct(F.lit("unknown_source").alias("problem"), F.col("source").alias("node")),
        F.struct(F.lit("unknown_target").alias("problem"), F.col("target").alias("node")))))
    bad_end = ends.join(nodes.select(F.col("id").alias("node")), "node", "left_anti").select("id", "problem")
    bare = relations.filter(F.coalesce(F.size("evidence_ids"), F.lit(0)) <= 0).select(
        "id", F.lit("no_evidence").alias("problem"))
    cited = relations.select("id", F.explode("evidence_ids").alias("ev"))
    lost = cited.join(evidence.select(F.col("id").alias("ev")), "ev", "left_anti").select(
        "id", F.lit("unknown_evidence").alias("problem"))
    return bad_end.unionAll(bare).unionAll(lost).distinct()


def leak_check(claims: DataFrame, facts: DataFrame, gate: Sequence[str]) -> DataFrame:
    """(s, p, o, problem): candidates published as facts and gated claims that are not.

    A triple that some gated claim supports may also have a candidate claim.
    """
    spo = ["s", "p", "o"]
    per = claims.groupBy(*spo).agg(F.bool_or(F.col("status").isin(*gate)).alias("_gated"))
    f = facts.select(*spo).distinct()
    leaked = per.filter("not _gated").join(f, spo, "left_semi").select(*spo, F.lit("candidate_published").alias("problem"))
    absent = per.filter("_gated").join(f, spo, "left_anti").select(*spo, F.lit("documented_missing").alias("problem"))
    return leaked.unionAll(absent)


def path_breaks(steps: DataFrame, key: Sequence[str], start: str, end: str) -> DataFrame:
    """Steps that do not continue from their predecessor, or miss the start or end.

    ``steps(<key>, pos, source, target, <start>, <end>)``; neighbours meet by an
    equality join on the position.
    """
    prev = steps.select(*key, (F.col("pos") + 1).alias("pos"), F.col("target").alias("_from"))
    last = steps.groupBy(*key).agg(F.max("pos").alias("_last"))
    j = steps.join(prev, [*key, "pos"], "left").join(last, list(key))
    expected = F.when(F.col("pos") == 0, F.col(start)).otherwise(F.col("_from"))
    broken = ~F.col("source").eqNullSafe(expected) | ((F.col("pos") == F.col("_last")) & (F.col("target") != F.col(end)))
    return j.filter(broken).select(*key, "pos", "source", "target")


def table_difference(stored: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Rows (with multiplicity) only in one table; empty when they are equal."""
    cols = stored.columns
    a = stored.select(*cols, F.lit(1).alias("_d"))
    b = recomputed.select(*cols, F.lit(-1).alias("_d"))
    return a.unionAll(b).groupBy(*cols).agg(F.sum("_d").alias("_d")).filter("_d <> 0").select(
        *cols, F.when(F.col("_d") > 0, F.lit("only_in_stored")).otherwise(F.lit("only_in_recomputed")).alias("side"),
        F.abs("_d").alias("copies"))


def row_hash(*cols: Column | str) -> Column:
    """64-bit hash of a row; xxhash64 passes over nulls, so their places are hashed too."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    missing = F.lit(0).cast("long")
    for i, c in enumerate(parts):
        missing = missing + F.when(c.isNull(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return F.xxhash64(missing, *parts)


def digest_difference(stored: DataFrame, recomputed: DataFrame, groups: int = 4096) -> DataFrame:
    """``table_difference`` of two tables that should be equal: groups whose digests agree are not compared row by row.

    Rows fall into ``groups`` by their hash.  A group's digest is its row count and the sums of two 64-bit hashes of its
    rows, so it combines on the map side; only rows of groups whose digests differ are shuffled and compared whole.
    """
    cols = stored.columns

    def hashed(df: DataFrame) -> DataFrame:
        df = df.select(*cols, row_hash(*cols).alias("_h"), row_hash(F.lit(1), *cols).alias("_g"))
        return df.withColumn("_group", F.pmod("_h", F.lit(groups)).cast("int"))

    def halves(h: str, sign: int) -> list[Column]:
        return [F.lit(sign) * F.shiftright(h, 32), F.lit(sign) * F.col(h).bitwiseAND(F.lit(0xFFFFFFFF))]

    def lanes(df: DataFrame, sign: int) -> DataFrame:
        values = [F.lit(sign).cast("long"), *halves("_h", sign), *halves("_g", sign)]
        return hashed(df).select("_group", *[v.alias(f"_l{i}") for i, v in enumerate(values)])

    names = [f"_l{i}" for i in range(5)]
    sums = lanes(stored, 1).unionAll(lanes(recomputed, -1)).groupBy("_group").agg(*[F.sum(c).alias(c) for c in names])
    differ = [r["_group"] for r in sums.filter(" or ".join(f"{c} <> 0" for c in names)).select("_group").collect()]
    a, b = (hashed(df).filter(F.col("_group").isin(differ) if differ else F.lit(False)).select(*cols) for df in (stored, recomputed))
    return table_difference(a, b)


def total_differences(totals: DataFrame, subject: str, source: str, total: str) -> DataFrame:
    """Published totals that disagree between sources; kept, not resolved."""
    out = totals.groupBy(subject).agg(F.count_distinct(source).alias("sources"), F.min(total).alias("lowest"),
                                      F.max(total).alias("highest"))
    return out.withColumn("unresolved", F.col("lowest") != F.col("highest"))


def list_length_issues(df: DataFrame, key: str, names: str, labels: str, declared: str | None = None) -> DataFrame:
    """Rows whose parallel lists, or list and declared count, differ in length."""
    n, m = F.size(names), F.size(labels)
    issues = [F.when(n != m, F.lit("name_label_length_mismatch"))]
    if declared:
        issues.append(F.when(F.col(declared) != n, F.lit("declared_count_differs")))
    return df.select(key, n.alias("names"), m.alias("labels"), F.array_compact(F.array(*issues)).alias("issues")).filter(
        F.size("issues") > 0)


def group_digests(rows: DataFrame, table: Sequence[str], position: str, cells: Sequence[str]) -> DataFrame:
    """Content digest of each table; the position makes row order count."""
    return rows.groupBy(*table).agg(*set_digest(F.col(position), *[F.col(c) for c in cells]))


def duplicate_tables(rows: DataFrame, table: Sequence[str], position: str, cells: Sequence[str]) -> DataFrame:
    """Tables whose rows repeat another table's: (table, copies, is_first)."""
    d = group_digests(rows, table, position, cells)
    same = d.groupBy("rows", "lane_a", "lane_b").agg(F.count(F.lit(1)).alias("copies"),
                                                     F.min(F.struct(*table)).alias("_first"))
    return d.join(same.filter("copies > 1"), ["rows", "lane_a", "lane_b"]).select(
        *table, "copies", (F.struct(*table) == F.col("_first")).alias("is_first"))


def superseded_failures(receipts: DataFrame, suffix: str) -> DataFrame:
    """Failed receipts paired with the retry that replaced them; originals stay."""
    base = F.regexp_replace("id", suffix, "")
    retry = receipts.filter((F.col("id") != base) & (F.col("status") == "fetched")).select(
        base.alias("previous"), F.col("id").alias("replacement"), F.col("requested_url").alias("_u"))
    failed = receipts.filter(F.col("status") == "fetch_unresolved").select(
        F.col("id").alias("previous"), F.col("error").alias("previous_error"), "requested_url")
    return failed.join(retry, "previous").withColumn("same_url", F.col("requested_url").eqNullSafe(F.col("_u"))).drop("_u")


def check_report(checks: DataFrame) -> DataFrame:
    """One row: number of checks, failures and the overall result of (name, passed) rows."""
    ok = F.coalesce("passed", F.lit(False))
    return checks.agg(F.count(F.lit(1)).alias("checks"), F.count_if(~ok).alias("failures"),
                      F.coalesce(F.bool_and(ok), F.lit(False)).alias("passed"))


def two_pass_reconcile(passes: DataFrame, subject: str, run: str, record: str, total: str) -> DataFrame:
    """Two sort orders of one listing: their union must reach the reported total."""
    per = passes.groupBy(subject, run, record).agg(F.count(F.lit(1)).alias("_n"), F.max(total).alias("_t"))
    by_record = per.groupBy(subject, record).agg(F.max("_t").alias("_t"), F.sum(F.col("_n") - 1).alias("_dup"),
                                                 F.count(F.lit(1)).alias("_runs"))
    return by_record.groupBy(subject).agg(
        F.count(F.lit(1)).alias("union_records"), F.sum("_dup").alias("duplicates_within_passes"),
        F.count_if(F.col("_runs") == 1).alias("seen_in_one_pass"), F.max("_t").alias("reported_total")).withColumn(
        "complete", F.col("union_records") == F.col("reported_total"))


def crosscheck_breakdown(rows: DataFrame, category: str, published: DataFrame) -> DataFrame:
    """Counts per category against independently published counts (category, published)."""
    mine = rows.groupBy(category).agg(F.count(F.lit(1)).alias("counted"))
    return mine.join(published, category, "full_outer").withColumn(
        "agrees", F.col("counted").eqNullSafe(F.col("published")))


def order_contiguity(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Whether the reported order column is 1..n without gaps or repeats."""
    per = df.groupBy(*group, order).agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy(*group).agg(
        F.min(order).alias("first_no"), F.max(order).alias("last_no"), F.sum("_n").alias("rows"),
        F.count(F.lit(1)).alias("distinct_numbers")).withColumn(
        "contiguous", (F.col("first_no") == 1) & (F.col("last_no") == F.col("rows"))
        & (F.col("distinct_numbers") == F.col("rows")))


def page_row_identity(df: DataFrame, number: str, page: str, position: str, size: int, total: str | None = None) -> DataFrame:
    """Rows whose running number differs from what page and position imply.

    Ascending listings start at 1; with ``total`` the listing counts down.
    """
    offset = (F.col(page) - 1) * size + F.col(position)
    expected = offset + 1 if total is None else F.col(total) - offset
    return df.withColumn("expected_no", expected).filter(~F.col(number).eqNullSafe(F.col("expected_no")))


def menu_sections(navigation: DataFrame, sections: DataFrame) -> DataFrame:
    """(anchor, problem): menu targets without a section and differing labels."""
    j = navigation.join(sections.select("anchor", "title"), "anchor", "left")
    return j.filter(F.col("title").isNull() | (F.col("title") != F.col("label"))).select(
        "anchor", F.when(F.col("title").isNull(), F.lit("target_without_section"))
        .otherwise(F.lit("label_differs")).alias("problem"))


def attribute_issues(df: DataFrame, cells: str, width: int, length: str, spans: str | None = None) -> DataFrame:
    """Add ``issues``: wrong arity, merged cells, unspecified length; values stay."""
    out = [F.when(F.size(cells) != width, F.lit("unexpected_row_width")),
           F.when(F.coalesce(F.trim(length), F.lit("")).isin("", "-", "?"), F.lit("length_not_specified"))]
    if spans:
        out.append(F.when(F.col(spans) > 1, F.lit("merged_cell")))
    return df.withColumn("issues", F.array_compact(F.array(*out)))


def occurrence_history(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(first, repeats): the first occurrence of each key and the later ones.

    The first place is a combinable minimum; rows then compare with it, so no
    key is sorted in one task.
    """
    place = F.struct(*order)
    first = df.groupBy(*keys).agg(F.min(place).alias("_p"))
    j = df.join(first, list(keys)).withColumn("_is", place == F.col("_p")).drop("_p")
    return j.filter("_is").drop("_is"), j.filter("not _is").drop("_is")


def set_relation(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: sizes, values only on either side, and equal/subset flags."""
    both = left.select(F.col(key), F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        right.select(F.col(key), F.lit(0).alias("a"), F.lit(1).alias("b")))
    per = both.groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return per.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("left_values"), F.coalesce(F.sum("b"), F.lit(0)).alias("right_values"),
        F.count_if((F.col("a") == 1) & (F.col("b") == 0)).alias("only_left"),
        F.count_if((F.col("a") == 0) & (F.col("b") == 1)).alias("only_right")).select(
        "*", ((F.col("only_left") == 0) & (F.col("only_right") == 0)).alias("equal"),
        (F.col("only_left") == 0).alias("left_is_subset"))


def multiset_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(value, left_copies, right_copies) of values with different multiplicity."""
    both = left.select(F.col(key), F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        right.select(F.col(key), F.lit(0).alias("a"), F.lit(1).alias("b")))
    return both.groupBy(key).agg(F.sum("a").alias("left_copies"), F.sum("b").alias("right_copies")).filter(
        "left_copies <> right_copies")


def evidence_ids(*parts: DataFrame) -> DataFrame:
    """Distinct evidence ids over plain and array columns named ``evidence_id(s)``."""
    cols = []
    for p in parts:
        if "evidence_ids" in p.columns:
            cols.append(p.select(F.explode("evidence_ids").alias("evidence_id")))
        else:
            cols.append(p.select("evidence_id"))
    out = cols[0]
    for c in cols[1:]:
        out = out.unionAll(c)
    return out.filter("evidence_id is not null").distinct()
