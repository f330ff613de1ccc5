"""Exact deduplication with keyed state that never expires.

Arrivals (digest, identifier, place of the content) stream through one stateful
aggregation, kept on disk by RocksDB: per digest the number of texts seen and the
largest identifier with the place of its content.  Spark combines arrivals inside
each task first, so a text that makes up a third of the input reaches its state as
one row per task.

With a ``state`` folder of its own a later run continues where the last one ended: its arrivals are added to those
of earlier runs, with their texts, so that the place of a content is a folder that still holds it.  Identifier and
group size then count all runs, and hits on digests of earlier runs are compared with those texts; the rows returned
are those of the run.  Identifiers keep their type from run to run; each run takes documents that are new to the
state, so one that broke off is repeated on a copy of the state from before it.

A digest hit is no proof: the whole text of every row that would go is compared
with that of the row that stays (a hot text is copied once per thousand hits, so no
task gets more).  Rows that differ are grouped by their text itself.

Texts are equal when identical after lower-casing A-Z; null counts as empty.  The
largest identifier stays; a null identifier is below all others.  Rows that repeat
the staying identifier and text stay too (``drop_copies`` leaves one of them).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.durable import materialize, scratch_root
from catalith.layout import dictionary_join
from catalith.llm.common import BATCH, ascii_lower, attach, settings, single, stored, text_hash, without
from catalith.llm.registry import query

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
           # Else every partition's store reserves megabytes for files that stay small.
           "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
           # All stores of an executor share one bound, and go when their batch is written: there is one a partition.
           "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
           "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
           "spark.sql.streaming.stateStore.unloadOnCommit": "true"}
#: Hits compared with one copy of a staying text.
HITS_PER_COPY = 1000


def arrivals(docs: DataFrame, key: str = "doc_id", text: str = "text", digits: int = 64, place: str | None = None) -> DataFrame:
    """Digest, identifier and content place of every row; ``digits`` shortens the digest (tests of collisions).

    With a ``place`` of its own each row carries the text that the place will hold.
    """
    held = [F.lit(place).alias("place"), ascii_lower(F.col(text)).alias("norm")] if place else [F.input_file_name().alias("place")]
    sha = F.sha2(ascii_lower(F.col(text)), 256)
    return docs.select(F.col(key).alias("k"), sha.alias("sha"), F.substring(sha, 1, digits).alias("digest"),
                       text_hash(F.col(text)).alias("h"), *held)


def stream_index(arriving: DataFrame, state: str) -> DataFrame:
    """Run the stream ``arriving`` (columns digest, k, place) to its end; the index of all digests of ``state``."""
    spark = arriving.sparkSession
    index = arriving.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("k", "place")).alias("keep"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{state}/index/run={batch}")

    with settings(spark, ROCKSDB):
        (index.writeStream.outputMode("update").option("checkpointLocation", f"{state}/stream")
         .foreachBatch(write).trigger(availableNow=True).start().awaitTermination())
    schema = index.schema
    rows = spark.read.schema(schema).parquet(f"{state}/index")
    # Counts and identifiers only grow, so the latest record of a digest is the largest.
    return rows.groupBy("digest").agg(F.max("n").alias("n"), F.max("keep").alias("keep")).select(
        "digest", "n", F.col("keep.k").alias("keep_k"), F.col("keep.place").alias("place"))


def _added(docs: DataFrame, state: str, key: str, text: str, digits: int) -> tuple[DataFrame, str]:
    """Add ``docs`` with their texts to the arrivals of ``state``; this run's rows and the folder of all runs."""
    folder = f"{state}/arrivals"
    place = f"{folder}/{uuid.uuid4().hex}"
    rows = arrivals(docs, key, text, digits, place)
    with settings(docs.sparkSession, BATCH):
        rows.write.parquet(place)
    return docs.sparkSession.read.schema(rows.schema).parquet(place), folder


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", state: str | None = None, digits: int = 64) -> DataFrame:
    """``(k, h, sha, keep_k, n)`` for every row of ``docs``: its identifier, text hash, digest, who stays, group size.

    ``state`` names a folder that keeps all runs; without it the state ends with the call.
    """
    spark = docs.sparkSession
    if state:
        seen, folder = _added(docs, state.rstrip("/"), key, text, digits)
    else:
        state, seen, folder = f"{scratch_root(spark)}/dedup-{uuid.uuid4().hex}", stored(arrivals(docs, key, text, digits), "arrivals"), None
    source = seen.inputFiles()
    if not source:
        return seen.select("k", "h", "sha", F.col("k").alias("keep_k"), F.lit(1).cast("long").alias("n"))
    fields = seen.drop("norm").schema
    stream = spark.readStream.schema(fields).option("recursiveFileLookup", "true").parquet(folder or source[0].rsplit("/", 1)[0])
    index = materialize(stream_index(stream, state), "index")
    out = attach(seen.select("k", "h", "sha", "digest"), index.select("digest", "n", "keep_k"), "digest", "n")
    out = out.select("k", "h", "sha", "digest", "keep_k", "n")

    several = index.filter("n > 1").select("digest", "n", "keep_k")
    if folder:
        # The texts of all runs, for the digests this run met.
        norm = spark.read.schema(seen.schema).option("recursiveFileLookup", "true").parquet(folder).select("k", "norm", "digest")
        several = several.join(seen.select("digest").distinct(), "digest", "left_semi")
    else:
        norm = docs.select(F.col(key).alias("k"), ascii_lower(F.col(text)).alias("norm"))
        norm = norm.withColumn("digest", F.substring(F.sha2("norm", 256), 1, digits))
    shared = materialize(dictionary_join(norm, several, ["digest"]), "shared")
    copies = F.ceil(F.col("n") / HITS_PER_COPY).cast("int")
    stays = (shared.filter(F.col("k").eqNullSafe(F.col("keep_k")))
             .groupBy("digest", "n").agg(F.max("norm").alias("kept_norm"))
             .select("digest", "kept_norm", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy")))
    hits = shared.withColumn("copy", F.pmod(F.xxhash64("k"), copies).cast("int"))
    collided = materialize(hits.join(stays, ["digest", "copy"]).filter("norm <> kept_norm").select("digest").distinct(), "collided")
    if collided.isEmpty():
        return out.drop("digest")
    mixed = shared.select("k", "digest", "norm").join(collided, "digest", "left_semi")
    by_text = mixed.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("keep_k"))
    apart = by_text.select(F.sha2("norm", 256).alias("sha"), F.xxhash64("norm").alias("nh"), "n", "keep_k", "digest")
    rest = out.join(collided, "digest", "left_anti").drop("digest")
    again = out.join(collided, "digest", "left_semi").drop("n", "keep_k").join(apart, ["digest", "sha"])
    return rest.unionByName(again.select("k", "h", "sha", "keep_k", "n"))


def drop_copies(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row per equal text."""
    table = materialize(groups(docs, key), "groups")
    stays = F.col("k").eqNullSafe(F.col("keep_k"))
    kept = without(docs, table.filter(~stays), key)
    # Repeats of one identifier and text: rare, so only these rows are grouped.
    twice = (table.filter(stays).groupBy(F.col("k").alias("_catalith_k"), F.col("sha").alias("_catalith_s")).agg(F.count(F.lit(1)).alias("c"))
             .filter("c > 1").drop("c"))
    same = (F.sha2(ascii_lower(F.col("text")), 256) == F.col("_catalith_s")) & F.col(key).eqNullSafe(F.col("_catalith_k"))
    return single(kept, materialize(twice, "twice"), same)


SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(x) AS text_sha256
FROM t WINDOW w AS (PARTITION BY x)
"""


@query("op10_exact_dedup", SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    rows = groups(spark.read.parquet(f"{folder}/documents.parquet"))
    return rows.select(F.col("k").alias("doc_id"), F.col("keep_k").alias("keep_id"), F.col("n").alias("group_size"),
                       F.col("k").eqNullSafe(F.col("keep_k")).alias("kept"), F.col("sha").alias("text_sha256"))
