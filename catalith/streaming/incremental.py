"""Incremental indexes as append-only logs resolved on read.

Each micro-batch writes its rows to its own ``batch`` folder, replacing that
folder when a batch is retried, so a restart neither loses nor repeats rows.
Readers take the newest version of each key; nothing is rewritten in place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalith.sources.definitions import definition_fields, documents_from_text


def append_batches(stream: DataFrame, path: str, checkpoint: str,
                   prepare: Callable[[DataFrame], DataFrame] | None = None, once: bool = True,
                   mode: str = "append") -> StreamingQuery:
    """Write every micro-batch of ``stream`` to ``path/batch=<id>``; with ``mode="update"`` the rows it changed."""
    def save(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def definition_stream(spark: SparkSession, path: str) -> DataFrame:
    """New definition documents as they arrive, one file each (many to a file: ``definition_bundle_stream``).

    A changed document must arrive under a new file name; the logical document
    name is the part before ``@``.
    """
    raw = spark.readStream.schema("value string").option("wholetext", True).text(path)
    file = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1)
    return raw.select(file.alias("file"), F.regexp_extract(file, "^([^@]+)", 1).alias("name"), "value",
                      F.col("_metadata.file_modification_time").alias("arrived_at"))


def definition_bundle_stream(spark: SparkSession, path: str) -> DataFrame:
    """New definition documents as they arrive, many to a file; rows as in ``definition_stream``.

    Each line is ``{"file": ..., "value": ...}``: the file name the document would have by itself, and its text.
    Another line is a document itself, named after its file and its own hash, so nothing unreadable is lost.
    Files cost the stream a listing and a log entry each, so bundles are the form for large arrivals.
    """
    raw = spark.readStream.schema("value string").text(path).filter("trim(value) <> ''")
    line = F.when(F.try_parse_json("value").isNotNull(), F.from_json("value", "file string, value string"))
    whole = line["file"].isNotNull() & line["value"].isNotNull()
    bundle = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1)
    own = F.concat(bundle, F.lit("#"), F.sha2("value", 256))
    rows = raw.select(F.when(whole, line["file"]).otherwise(own).alias("file"), F.when(whole, line["value"]).otherwise(F.col("value")).alias("value"),
                      F.col("_metadata.file_modification_time").alias("arrived_at"))
    return rows.select("file", F.regexp_extract("file", "^([^@]+)", 1).alias("name"), "value", "arrived_at")


def incremental_index(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the definition index current: one log row per arrived document."""
    return append_batches(stream, path, checkpoint)


def current_documents(log: DataFrame) -> DataFrame:
    """Newest version of each document; parse errors keep the reason."""
    rest = [c for c in log.columns if c != "name"]
    return log.groupBy("name").agg(F.max_by(F.struct(*rest), F.struct("batch", "arrived_at", "file")).alias("_w")).select(
        "name", "_w.*")


def current_definitions(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fields, errors) of the newest documents; older fields have disappeared."""
    docs = documents_from_text(current_documents(log), "name", "value")
    return definition_fields(docs), docs.filter("error is not null").select("path", "error")


def upsert_view(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write wins by key; keys absent from later listings stay."""
    rest = [c for c in log.columns if c not in key]
    return log.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_w"),
                                 F.count(F.lit(1)).alias("versions")).select(*key, "_w.*", "versions")


def history_flags(log: DataFrame, key: Sequence[str], batch: str) -> DataFrame:
    """Per key: first and last batch and whether it is missing from the newest listing."""
    newest = log.agg(F.max(batch).alias("n")).first()["n"]  # one number
    per = log.groupBy(*key).agg(F.min(batch).alias("first_batch"), F.max(batch).alias("last_batch"))
    return per.withColumn("kept_as_history", F.col("last_batch") < F.lit(newest))


def supersede_if_default_seen(variants: DataFrame, stored: DataFrame) -> DataFrame:
    """Replace a stored definition by its variants only if the default one was found.

    ``variants(key, pos, status, definition)`` with position 0 the default;
    ``stored(key, definition)``.  Output (key, definition, origin): the replaced
    definition stays with origin ``replaced``.
    """
    seen = variants.filter((F.col("pos") == 0) & (F.col("status") == "column_definition_observed")).select("key").distinct()
    new = variants.filter("status = 'column_definition_observed'").join(seen, "key", "left_semi").select(
        "key", "definition", F.lit("current").alias("origin"))
    kept = stored.join(seen, "key", "left_anti").select("key", "definition", F.lit("current").alias("origin"))
    old = stored.join(seen, "key", "left_semi").select("key", "definition", F.lit("replaced").alias("origin"))
    return new.unionAll(kept).unionAll(old)


def retain(df: DataFrame, ts: str, days: int, now: str | None = None) -> DataFrame:
    """Rows of the last ``days`` days before ``now`` (default: the current time)."""
    at = F.to_timestamp(F.lit(now)) if now else F.current_timestamp()
    return df.filter(F.col(ts) >= at - F.make_dt_interval(F.lit(days)))
