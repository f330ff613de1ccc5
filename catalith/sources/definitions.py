"""Definition documents, receipts and line-delimited JSON inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions.text import blank_to_null


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each JSON document as (path, doc VARIANT, error); unreadable ones keep the reason."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return documents_from_text(raw, "path", "value")


def documents_from_text(df: DataFrame, key: str, text: str, keep_text: bool = False) -> DataFrame:
    """(path, doc, error) of JSON texts; with ``keep_text`` also ``_text``, so that a search need not write ``doc`` out again."""
    parsed = F.try_parse_json(F.col(text))
    return df.select(F.col(key).alias("path"), parsed.alias("doc"),
                     F.when(parsed.isNull(), F.lit("invalid_json")).alias("error"), *[F.col(text).alias("_text")] * keep_text)


def json_value(doc: Column | str, path: str, kind: str = "string") -> Column:
    """A value of an open JSON column, null when absent or of another type."""
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, path, kind)


def json_items(doc: Column | str, path: str) -> Column:
    """Elements of a JSON array as an array of VARIANT; empty when absent."""
    return F.coalesce(json_value(doc, path, "array<variant>"), F.array().cast("array<variant>"))


def json_array_length(doc: Column | str, path: str) -> Column:
    return F.size(json_items(doc, path))


def definition_heads(docs: DataFrame) -> DataFrame:
    """One row per readable document, also for those without fields: path, portal_id, dataset_key, dataset_kind."""
    return docs.filter("error is null").select(
        "path", json_value("doc", "$.portal_id").alias("portal_id"), json_value("doc", "$.dataset_key").alias("dataset_key"),
        F.coalesce(json_value("doc", "$.dataset_kind"),
                   F.when(json_value("doc", "$.portal_id") == "data-go", F.lit("FILE"))).alias("dataset_kind"))


def definition_fields(docs: DataFrame) -> DataFrame:
    """Flatten ``fields[]`` of each document with a 1-based ordinal.

    Empty text and a lone dash in an attribute mean unknown.  A field's own
    evidence id wins over the document's.
    """
    base = docs.filter("error is null").select(
        "path", json_value("doc", "$.portal_id").alias("portal_id"),
        json_value("doc", "$.dataset_key").alias("dataset_key"),
        F.coalesce(json_value("doc", "$.dataset_kind"),
                   F.when(json_value("doc", "$.portal_id") == "data-go", F.lit("FILE"))).alias("dataset_kind"),
        json_value("doc", "$.evidence_id").alias("document_evidence_id"),
        json_value("doc", "$.source_url").alias("source_url"),
        F.posexplode(json_items("doc", "$.fields")).alias("pos", "f"))
    attrs = {c: blank_to_null(json_value("f", f"$.{c}")) for c in ("name", "name_en", "description", "datatype", "unit")}
    own = json_value("f", "$.evidence_id")
    return base.select(
        "path", "portal_id", "dataset_key", "dataset_kind", "source_url",
        (F.col("pos") + 1).cast("int").alias("ordinal"),
        *[v.alias(k) for k, v in attrs.items()],
        F.coalesce(F.when(own != "", own), F.col("document_evidence_id")).alias("evidence_id"),
        F.coalesce(json_value("f", "$.role"), F.lit("documented_column")).alias("role"),
        json_value("f", "$.locator").alias("locator"),
        F.lit("definition_observed_not_data_validated").alias("status"),
        F.col("f").alias("definition"))


def attach_definitions(fields: DataFrame, records: DataFrame) -> DataFrame:
    """Link definitions to every registration with the same portal and key.

    A document that names a kind only matches registrations of that kind; one
    document may serve many registrations (repeated provider links).
    """
    keys = records.select(F.col("id").alias("record_id"), "portal_id", "dataset_key", F.col("kind").alias("_kind"))
    return (fields.join(keys, ["portal_id", "dataset_key"])
            .filter(F.col("dataset_kind").isNull() | (F.col("dataset_kind") == F.col("_kind"))).drop("_kind"))


def unmatched_documents(fields: DataFrame, records: DataFrame) -> DataFrame:
    """Documents that match no registration; reported, never dropped silently.

    Given ``definition_heads``, documents without any field are reported as well.
    """
    matched = attach_definitions(fields, records).select("path").distinct()
    return fields.select("path", "portal_id", "dataset_key").distinct().join(matched, "path", "left_anti")


RECEIPT_SCHEMA = ("id string, requested_url string, final_url string, retrieved_at timestamp, status string, "
                  "http_status int, sha256 string, bytes long, raw_file string, error string")


def read_receipts(spark: SparkSession, path: str) -> DataFrame:
    """Evidence receipts, one JSON object per file or per line.

    A file is one receipt if it is one JSON object and its first line is none by itself; else every
    line is a receipt.  What does not parse becomes a row of its own whose ``error`` holds the raw
    text, be it a truncated line among good ones or a file without any receipt; empty files give no row.
    """
    def parses(text: Column) -> Column:
        # Within brackets, so that anything after the object is an error, too.
        one = F.trim(text).startswith("{") & F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()
        return F.coalesce(one, F.lit(False))

    files = spark.read.text(path, wholetext=True).select("value", F.filter(
        F.split("value", r"\r?\n"), lambda x: F.trim(x) != "").alias("lines")).filter(F.size("lines") > 0)
    by_line = parses(F.get("lines", F.lit(0))) | (~parses(F.col("value")) & F.exists("lines", parses))
    texts = files.select(F.explode(F.when(by_line, F.col("lines")).otherwise(F.array("value"))).alias("t"))
    read = texts.select(F.from_json("t", RECEIPT_SCHEMA).alias("r"), "t", parses(F.col("t")).alias("ok"))
    error = F.when(F.col("ok"), F.col("r.error")).otherwise(F.concat(F.lit("unreadable receipt: "), F.col("t")))
    good = F.when(F.col("ok"), F.col("r"))
    names = [c.split()[0] for c in RECEIPT_SCHEMA.split(", ")]
    return read.select(*[error.alias(c) if c == "error" else good[c].alias(c) for c in names])


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    """Raw evidence bytes with their file name; gzip files stay compressed."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Line-delimited JSON, gzip or plain, with a declared schema."""
    return spark.read.schema(schema).json(path)
