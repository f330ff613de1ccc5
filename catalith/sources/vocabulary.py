"""Concept vocabulary: concepts, aliases and their relationships.

The vocabulary is the project's own editable table, so it is read from a file or
a DataFrame.  Only the short facet and topic lists are built in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The eight facets.
FACETS = ("Topic", "Measure", "EntityType", "Dimension", "SpatialReference",
          "TemporalReference", "IdentifierScheme", "Unit")
# The sixteen topics with their exact lexical candidates.
TOPICS = (
    ("population", "인구·가구", "인구|가구|인구/가구"),
    ("employment", "고용·노동", "고용|노동|고용·노동|임금"),
    ("economy", "경제·금융", "경제|금융|경제일반|금융·보험|물가"),
    ("industry", "산업·기업", "산업|기업|사업체|산업/경제"),
    ("transport", "교통·물류", "교통|물류|교통·물류"),
    ("land", "국토·주택·주소", "국토|주택|건설|도시관리|주택/건설"),
    ("environment", "환경·기상·수문", "환경|기상|수문"),
    ("agriculture", "농림·수산·식품", "농림|농업|수산|식품|농림어업"),
    ("health", "보건·의료", "보건|의료|보건의료"),
    ("welfare", "복지·사회", "복지|사회|사회복지"),
    ("education", "교육", "교육"),
    ("culture", "문화·관광·체육", "문화|관광|체육|문화/관광"),
    ("administration", "행정·재정", "행정|재정|일반행정"),
    ("law", "정치·법률", "정치|법률|법무|입법"),
    ("science", "과학·기술·정보통신", "과학|기술|정보통신|과학기술"),
    ("safety", "안전·재난", "안전|재난|공공질서및안전"),
)

ROW_SCHEMA = "kind string, slug string, label string, topic string, aliases string, scope_checks string"


@dataclass(frozen=True)
class Vocabulary:
    """concepts(id, kind, label, aliases[], scope_checks[], topics[], status),
    aliases(alias, concept_id, kind) and relationships(id, source, predicate, target)."""

    concepts: DataFrame
    aliases: DataFrame
    relationships: DataFrame


def topic_rows(spark: SparkSession) -> DataFrame:
    """The built-in topics in the row shape of ``concept_vocabulary``."""
    rows = [("Topic", slug, label, None, aliases, None) for slug, label, aliases in TOPICS]
    return spark.createDataFrame(rows, ROW_SCHEMA)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Concept rows from a header CSV/TSV file with the columns of ``ROW_SCHEMA``."""
    sep = "\t" if path.endswith((".tsv", ".tsv.gz")) else ","
    return spark.read.schema(ROW_SCHEMA).option("header", True).option("sep", sep).option("escape", '"').csv(path)


def concept_vocabulary(rows: DataFrame, distinctions: DataFrame | None = None) -> Vocabulary:
    """Build the vocabulary from concept rows (aliases split by ``|``, checks by ``·``).

    ``distinctions(a, b)`` names slugs that must not be taken as synonyms.  A
    slug used by several kinds resolves to the kind that comes last in facet
    order, so ``person`` is the unit, not the entity type.
    """
    ident = F.concat(F.lower("kind"), F.lit(":"), F.col("slug"))
    concepts = rows.select(
        ident.alias("id"), "kind", "slug", "label",
        F.split(F.coalesce("aliases", F.lit("")), "\\|").alias("aliases"),
        F.filter(F.split(F.coalesce("scope_checks", F.lit("")), "·"), lambda x: x != "").alias("scope_checks"),
        F.when(F.col("topic").isNotNull(), F.array(F.concat(F.lit("topic:"), F.col("topic"))))
        .otherwise(F.array().cast("array<string>")).alias("topics"),
        F.lit("project_draft").alias("status"), F.lit(False).alias("human_approved"))
    aliases = concepts.select(F.explode("aliases").alias("alias"), F.col("id").alias("concept_id"), "kind").filter(
        "alias <> ''").distinct()
    member = concepts.select(F.col("id").alias("source"), F.explode("topics").alias("target")).select(
        F.concat(F.lit("topic-membership:"), "source").alias("id"), "source",
        F.lit("inTopic").alias("predicate"), "target")
    relationships = member
    if distinctions is not None:
        order = F.array_position(F.lit(list(FACETS)), F.col("kind"))
        by_slug = concepts.groupBy("slug").agg(F.max_by("id", order).alias("id"))
        # Targets follow the same rule; both sides may resolve across facets.
        rel = (distinctions.join(by_slug.select(F.col("slug").alias("a"), F.col("id").alias("source")), "a")
               .join(by_slug.select(F.col("slug").alias("b"), F.col("id").alias("target")), "b"))
        relationships = member.unionByName(rel.select(
            F.concat(F.lit("distinction:"), "a", F.lit(":"), "b").alias("id"), "source",
            F.lit("distinguishFrom").alias("predicate"), "target"))
    relationships = relationships.withColumn("status", F.lit("project_proposal")).withColumn(
        "human_approved", F.lit(False))
    return Vocabulary(concepts, aliases, relationships)
