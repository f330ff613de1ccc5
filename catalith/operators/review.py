"""Human review of proposed relations: tasks, state machine, staleness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.text import fingerprint
from catalith.layout import dictionary_join, set_digest
from catalith.operators.scan import segmented_scan

# States, legal transitions and approval fields of the review policy.
STATES = ("proposed", "under_review", "needs_revision", "approved", "rejected", "stale", "revoked", "superseded")
TRANSITIONS: Mapping[str, tuple[str, ...]] = {
    "proposed": ("under_review",),
    "under_review": ("approved", "needs_revision", "rejected"),
    "needs_revision": ("superseded",),
    "approved": ("stale", "revoked", "superseded"),
    "rejected": ("superseded",),
    "stale": ("under_review", "revoked", "superseded"),
    "revoked": ("superseded",),
    "superseded": (),
}
APPROVAL_FIELDS = ("reviewer_id", "reviewed_at", "proposal_fingerprint", "evidence_snapshots", "review_method",
                   "applicability_scope", "decision_rationale")
# What an approval of these kinds of relation states besides.
EXTRA_FIELDS = {
    "statistical_relation": ("analysis_run_id", "input_versions", "variable_definitions", "sample_size", "preprocessing",
                             "code_hash", "result", "uncertainty", "limitations"),
    "semantic_topic": ("metadata_version", "concept_version", "embedding_model_version", "field_scores",
                       "evaluation_set_version", "applicability_scope"),
}
REVIEW_FIELDS = ("status", "reviewer", "reviewed_at", "decision", "rationale", "evidence_refs", "scope_conditions")


def review_tasks(relations: DataFrame, nodes: DataFrame, evidence: DataFrame, methods: DataFrame) -> DataFrame:
    """One proposed review task per relation.

    The fingerprint covers the relation, both endpoints and all its evidence, so
    any change makes it differ.  Evidence enters as an order-free digest, which
    keeps a relation with very many evidence rows out of a single task.
    ``nodes(id, label, ...)``, ``evidence(id, sha256, ...)``, ``methods(role, review_method)``.
    """
    def content(df: DataFrame, alias: str) -> DataFrame:
        rest = [c for c in sorted(df.columns) if c != "id"]
        return df.select(F.col("id").alias(alias), F.sha2(F.to_json(
            F.struct("id", *rest), {"ignoreNullFields": "false"}), 256).alias(f"_{alias}"))

    cited = relations.select("id", F.explode("evidence_ids").alias("ev"))
    proof = dictionary_join(cited, content(evidence, "ev"), ["ev"], "left").groupBy("id").agg(
        *set_digest(F.col("ev"), F.col("_ev")))
    proof = proof.select("id", F.concat_ws(":", "rows", "lane_a", "lane_b").alias("_proof"))
    out = dictionary_join(relations, content(nodes, "source"), ["source"], "left")
    out = dictionary_join(out, content(nodes, "target"), ["target"], "left")
    out = dictionary_join(out, methods, ["role"], "left").join(proof, "id", "left")
    body = {c: F.col(c) for c in relations.columns}
    body |= {"source_content": F.col("_source"), "target_content": F.col("_target"), "evidence_content": F.col("_proof")}
    return out.select(
        F.col("id").alias("relation_id"), "source", "target", "predicate", "role",
        F.col("status").alias("legacy_evidence_status"), "evidence_ids", "review_method",
        F.lit("proposed").alias("workflow_state"), fingerprint(**body).alias("proposal_fingerprint"),
        F.lit(None).cast("string").alias("reviewer_id"), F.lit(None).cast("string").alias("decision"))


def _step(start: Column, claimed: Column, to: Column) -> Column:
    """State after one event from ``start``; illegal events leave it unchanged."""
    legal = F.lit(False)
    for a, targets in TRANSITIONS.items():
        if targets:
            legal = legal | ((start == a) & to.isin(*targets))
    ok = F.coalesce(legal & (claimed.isNull() | (claimed == start)), F.lit(False))
    return F.when(ok, to).otherwise(start)


def apply_review_events(events: DataFrame, key: str, order: Sequence[str], to_state: str,
                        from_state: str | None = None, initial: str = "proposed") -> DataFrame:
    """Run each proposal's events through the state machine in order.

    Adds ``state_before``, ``state_after`` and ``accepted``; rejected events stay
    in the output.  Every event is a function from state to state and functions
    compose associatively, so a proposal holding a third of all events is folded
    in chunks.  ``order`` must be unique within a proposal.
    """
    claimed = F.col(from_state) if from_state else F.lit(None).cast("string")
    table = F.array(*[_step(F.lit(s), claimed, F.col(to_state)) for s in STATES])
    names = F.lit(list(STATES))
    identity = F.lit(list(STATES))

    def compose(a: Column, b: Column) -> Column:
        return F.transform(a, lambda s: F.element_at(b, F.array_position(names, s).cast("int")))

    scanned = segmented_scan(events, key, order, table, compose, identity, "_fn")
    before = F.element_at("_fn", F.array_position(names, F.lit(initial)).cast("int"))
    out = scanned.withColumn("state_before", before)
    out = out.withColumn("state_after", _step(F.col("state_before"), claimed, F.col(to_state)))
    return out.withColumn("accepted", F.col("state_before") != F.col("state_after")).drop("_fn")


def current_states(applied: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Latest state and accepted/rejected counts of each proposal."""
    return applied.groupBy(key).agg(
        F.max_by("state_after", F.struct(*order)).alias("state"),
        F.count_if("accepted").alias("accepted_events"), F.count_if(~F.col("accepted")).alias("rejected_events"))


def invalidate(approvals: DataFrame, current: DataFrame, compare: Sequence[str]) -> DataFrame:
    """Approved proposals become stale when a compared value changed or vanished.

    ``approvals(id, state, <compare>)``, ``current(id, <compare>)``; values that
    are unknown on both sides count as equal.
    """
    now = current.select("id", *[F.col(c).alias(f"_{c}") for c in compare], F.lit(True).alias("_present"))
    j = approvals.join(now, "id", "left")
    changed = ~F.coalesce("_present", F.lit(False))
    reasons = [F.when(F.col("_present").isNull(), F.lit("evidence_withdrawal"))]
    for c in compare:
        differs = F.col("_present").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_{c}"))
        changed = changed | differs
        reasons.append(F.when(differs, F.lit(f"{c}_changed")))
    return j.select(
        *approvals.columns, F.when((F.col("state") == "approved") & changed, F.lit("stale")).otherwise(
            F.col("state")).alias("state_now"), F.array_compact(F.array(*reasons)).alias("triggers"))


def approval_valid(reviews: DataFrame, actor: str = "actor_kind", kind: str | None = None) -> DataFrame:
    """Adds ``missing_fields`` and ``valid``: complete and decided by a person.

    ``kind`` names the column with the kind of relation; a kind in ``EXTRA_FIELDS`` must state those fields, too.
    A field without a column is missing from every row that needs it; empty lists count as missing.
    """
    types = dict(reviews.dtypes)

    def absent(c: str) -> Column:
        if c not in types:
            return F.lit(True)
        empty = F.size(c) == 0 if types[c].startswith(("array", "map")) else F.col(c).cast("string") == ""
        return F.col(c).isNull() | empty

    needed = [F.when(absent(c), F.lit(c)) for c in APPROVAL_FIELDS]
    if kind is not None:
        for name, fields in EXTRA_FIELDS.items():
            needed += [F.when((F.col(kind) == name) & absent(c), F.lit(c)) for c in fields if c not in APPROVAL_FIELDS]
    missing = F.array_compact(F.array(*needed))
    out = reviews.withColumn("missing_fields", missing)
    return out.withColumn("valid", (F.size("missing_fields") == 0) & F.coalesce(F.col(actor) == "human", F.lit(False)))


def carry_reviews(sample: DataFrame, queue: DataFrame, outside: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, outside): the new queue with earlier decisions kept.

    A sampled mapping that had vanished gets its decision back; decisions of
    mappings outside the new sample are kept apart.  The current queue wins over
    the outside list when both know an id.
    """
    fields = [c for c in REVIEW_FIELDS if c in queue.columns]
    prior = queue.select("id", *fields, F.lit(0).alias("_r")).unionByName(
        outside.select("id", *fields, F.lit(1).alias("_r")))
    prior = prior.groupBy("id").agg(F.min_by(F.struct(*fields), "_r").alias("_p"))
    joined = sample.join(prior, "id", "left")
    keep = [c for c in sample.columns if c not in fields]
    items = joined.select(*keep, *[
        F.when(F.col("_p").isNotNull(), F.col(f"_p.{c}")).otherwise(F.col(c) if c in sample.columns else F.lit(None)).alias(c)
        for c in fields])
    rest = prior.join(sample.select("id"), "id", "left_anti").select("id", "_p.*")
    return items, rest


def review_table(relations: DataFrame, reviews: DataFrame) -> DataFrame:
    """Relations with their review state, ready to be grouped by role for display."""
    st = reviews.select(F.col("relation_id").alias("id"), "workflow_state", "note")
    return relations.join(st, "id", "left").select(
        "role", "id", "source", "predicate", "target", F.coalesce("workflow_state", F.lit("proposed")).alias("state"),
        "note", F.array_sort("evidence_ids").alias("evidence_ids"))


def issue_impact(issues: DataFrame, datasets: DataFrame, relations: DataFrame, reviews: DataFrame) -> DataFrame:
    """Counts of datasets, relations and reviews touched by each reproduced issue.

    ``issues(issue_id, dataset_id, dataset_version, state)``; relations touch a
    dataset as source or target; reviews follow the relation.
    """
    hit = issues.filter("state = 'reproduced'").select("issue_id", "dataset_id", "dataset_version")
    sets = hit.join(datasets.select("dataset_id", "dataset_version"), ["dataset_id", "dataset_version"])
    ends = relations.select(F.col("id").alias("relation_id"), F.explode(F.array_distinct(F.array("source", "target"))).alias("dataset_id"))
    rels = sets.join(ends, "dataset_id").select("issue_id", "relation_id").distinct()
    revs = rels.join(reviews.groupBy("relation_id").agg(F.count(F.lit(1)).alias("_n")), "relation_id")
    return (hit.select("issue_id").distinct()
            .join(sets.groupBy("issue_id").agg(F.count_distinct("dataset_id").alias("datasets")), "issue_id", "left")
            .join(rels.groupBy("issue_id").agg(F.count(F.lit(1)).alias("relations")), "issue_id", "left")
            .join(revs.groupBy("issue_id").agg(F.sum("_n").alias("reviews")), "issue_id", "left")
            .na.fill(0, ["datasets", "relations", "reviews"]))
