"""Exports: ordered JSON lines, numbered shards, receipt buckets, snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions.url import has_secret, redact_url
from catalith.layout import dense_row_number
from catalith.operators.scan import segmented_scan

# Rows per shard and the public receipt columns.
SHARD_ROWS = 5000
RECEIPT_COLUMNS = ("id", "requested_url", "retrieved_at", "status", "sha256")


def write_jsonl(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Gzip JSON lines, globally ordered across the part files."""
    df.orderBy(*order).write.mode("errorifexists").option("compression", "gzip").option(
        "ignoreNullFields", "false").json(path)


def redact_columns(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Column]:
    """(df with secrets replaced, count of redacted values as an aggregate column)."""
    n = F.lit(0)
    out = df
    for c in columns:
        n = n + F.count_if(has_secret(c))
        out = out.withColumn(c, redact_url(c))
    return out, n.alias("redacted_url_parameters")


def shard_no(row_no: Column, rows: int = SHARD_ROWS) -> Column:
    return F.floor((row_no - 1) / rows).cast("int")


def with_shards(df: DataFrame, order: Sequence[str], rows: int = SHARD_ROWS, row_no: str | None = None) -> DataFrame:
    """Add ``row_no`` and ``shard``; pass ``row_no`` when ids are already dense from 1."""
    out = dense_row_number(df, order, "row_no") if row_no is None else df.withColumn("row_no", F.col(row_no))
    return out.withColumn("shard", shard_no(F.col("row_no"), rows))


def shard_stats(items: DataFrame) -> DataFrame:
    """Per (shard, portal, kind): rows, mapped rows and record range.

    ``items(shard, portal_id, kind, record_id, concept_ids)``.
    """
    return items.groupBy("shard", "portal_id", "kind").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.size("concept_ids") > 0).alias("mapped_rows"),
        F.min("record_id").alias("first_record"), F.max("record_id").alias("last_record"))


def shard_concepts(items: DataFrame) -> DataFrame:
    """Per (shard, portal, kind, concept): occurrences."""
    return items.select("shard", "portal_id", "kind", F.explode("concept_ids").alias("concept_id")).groupBy(
        "shard", "portal_id", "kind", "concept_id").agg(F.count(F.lit(1)).alias("occurrences"))


def shard_manifest(items: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per shard: rows, first and last key, SHA-256 of its ordered JSON rows.

    A shard has a fixed number of rows, which bounds the list hashed per group.
    """
    line = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_no", line.alias("line")))),
                                    lambda x: x["line"]), "\n")
    return items.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.min_by(key, "row_no").alias("first"), F.max_by(key, "row_no").alias("last"),
        F.sha2(body, 256).alias("sha256"))


def export_shards(df: DataFrame, path: str, order: Sequence[str], key: str, rows: int = SHARD_ROWS) -> DataFrame:
    """Write consecutive shards under ``path`` and return their manifest.

    The rows are numbered once and written once; the manifest is computed from
    the written files, so it describes what readers will see.
    """
    columns = df.columns
    numbered = with_shards(df, order, rows)
    (numbered.repartitionByRange("row_no").sortWithinPartitions("row_no")
     .write.mode("errorifexists").partitionBy("shard").parquet(path))
    written = df.sparkSession.read.parquet(path)
    return shard_manifest(written, key, columns)


def verify_shards(spark: SparkSession, path: str, manifest: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Manifest entries that differ from a recomputation over the stored shards."""
    now = shard_manifest(spark.read.parquet(path), key, columns)
    a = manifest.select("shard", F.struct("rows", "first", "last", "sha256").alias("declared"))
    b = now.select("shard", F.struct("rows", "first", "last", "sha256").alias("actual"))
    return a.join(b, "shard", "full_outer").filter(~F.col("declared").eqNullSafe(F.col("actual")))


def shards_for_page(stats: DataFrame, matches: Column, number: int, size: int) -> DataFrame:
    """Shards that hold a page, from the stats alone: shard, matches, before.

    ``matches`` is the matching-row count of a stats row under the filter.  The
    running total over shards is a chunked scan, not one ordered window.
    """
    per = stats.groupBy("shard").agg(F.sum(matches).cast("long").alias("matches")).filter("matches > 0")
    per = per.withColumn("_all", F.lit(0))
    scanned = segmented_scan(per, "_all", ["shard"], F.col("matches"), lambda a, b: a + b, F.lit(0).cast("long"), "before")
    lo, hi = (number - 1) * size, number * size
    return scanned.filter((F.col("before") < hi) & (F.col("before") + F.col("matches") > lo)).select(
        "shard", "matches", "before")


def receipt_bucket(c: Column | str) -> Column:
    """First byte of SHA-256 of an evidence id, as two hex digits."""
    return F.substring(F.sha2(F.col(c) if isinstance(c, str) else c, 256), 1, 2)


def export_receipts(receipts: DataFrame, path: str, cited: DataFrame | None = None) -> None:
    """Write the public receipt columns in 256 hash buckets, secrets replaced."""
    out = receipts if cited is None else receipts.join(
        cited.select(F.col("evidence_id").alias("id")).distinct(), "id", "left_semi")
    out, _ = redact_columns(out.select(*RECEIPT_COLUMNS), ["requested_url"])
    out = out.withColumn("bucket", receipt_bucket("id"))
    # Buckets hash the unique id, so they are even; each is written by one task.
    out.repartition("bucket").write.mode("errorifexists").partitionBy("bucket").parquet(path)


def read_receipt(spark: SparkSession, path: str, evidence_id: str) -> DataFrame:
    """One receipt; the bucket predicate prunes the scan to a single directory."""
    bucket = receipt_bucket(F.lit(evidence_id))
    return spark.read.option("basePath", path).parquet(path).filter(
        (F.col("bucket") == bucket) & (F.col("id") == evidence_id)).drop("bucket")


def snapshot_swap(df: DataFrame, root: str) -> str:
    """Publish a new complete snapshot; readers never see a partial one.

    The data goes to a fresh folder; only after it is complete does a one-row
    pointer file make it current.  Earlier snapshots stay.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.mode("errorifexists").parquet(f"{root}/data/{version}")
    number = _pointers(spark, root).agg(F.coalesce(F.max("number"), F.lit(0)).alias("n")).first()["n"] + 1
    spark.createDataFrame([(number, version)], "number long, version string").coalesce(1).write.mode("append").json(
        f"{root}/pointer")
    return version


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    schema = "number long, version string"
    try:
        return spark.read.schema(schema).json(f"{root}/pointer")
    except Exception as error:  # no snapshot yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed snapshot."""
    row = _pointers(spark, root).orderBy(F.desc("number")).limit(1).collect()
    if not row:
        raise ValueError("no committed snapshot")
    return spark.read.parquet(f"{root}/data/{row[0]['version']}")


def overview(counts: DataFrame, portals: DataFrame, concepts: DataFrame, edges: DataFrame, **rules: bool) -> DataFrame:
    """One-row summary document: totals of every part, edges by kind and the rules.

    The parts themselves stay tables; the document holds their sizes.
    """
    kinds = edges.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("edges_by_kind"))
    sizes = (portals.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("portals"))
             .unionAll(concepts.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("concepts")))
             .unionAll(edges.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("edges")))
             .unionAll(edges.select("portal_id", "concept_id").distinct().agg(F.count(F.lit(1)).alias("n"))
                       .withColumn("part", F.lit("portal_concept_pairs"))))
    sizes = sizes.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("part", "n")))).alias("sizes"))
    # Three one-row tables put side by side: stack them and keep the set value.
    rows = counts.select(F.struct(*counts.columns).alias("counts")).unionByName(kinds, allowMissingColumns=True)
    rows = rows.unionByName(sizes, allowMissingColumns=True)
    j = rows.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("counts", "edges_by_kind", "sizes")])
    flags = F.struct(*[F.lit(v).alias(k) for k, v in sorted(rules.items())]) if rules else F.struct(F.lit(True).alias("draft"))
    return j.select(F.to_json(F.struct("counts", "sizes", "edges_by_kind", flags.alias("rules"))).alias("overview"))
