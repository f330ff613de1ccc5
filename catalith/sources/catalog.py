"""Catalogue registrations and their declared tokens.

``records`` has thirteen text columns plus the whole source row as a VARIANT in
``metadata``; nothing about the source schema is guessed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.functions import text as tx

# The columns of a registration, the bulk file's kinds and the
# page-name suffix of each kind.
RECORD_COLUMNS = ("id", "portal_id", "dataset_key", "title", "provider_id", "provider_name", "kind",
                  "url", "evidence_id", "locator", "output_raw", "request_raw", "schema_status")
BULK_KINDS = {"FILE": "fileData", "API": "openapi", "STD": "standard"}
BULK_COLUMNS = ("list_key", "title", "keywords", "provider", "provider_code", "kind", "service_type",
                "format", "request_vars", "outputs", "cycle", "total_rows")
BULK_HEADER = ("목록키", "목록명", "키워드", "제공기관명", "제공기관코드", "목록유형",
               "서비스 유형", "데이터포맷", "요청변수", "출력결과", "주기", "전체행")


def read_bulk_csv(
    spark: SparkSession, path: str, encoding: str = "MS949",
    header: tuple[str, ...] = BULK_HEADER, columns: tuple[str, ...] = BULK_COLUMNS,
) -> DataFrame:
    """Rows of bulk catalogue files with their logical record number.

    Adds ``file``, ``row_no`` (data rows from 1) and ``shape_ok`` (the row had
    exactly the expected number of cells).  Every file must start with
    ``header``.  CP949 needs ``spark.sql.legacy.javaCharsets=true``, which holds
    while the files are read and no longer.  Quoted line breaks are legal, so one file
    is one task; the bulk set is many files.
    """
    schema = ", ".join(f"{c} string" for c in columns) + ", _bad string"
    raw = (spark.read.schema(schema).option("encoding", encoding).option("multiLine", True)
           .option("escape", '"').option("columnNameOfCorruptRecord", "_bad").csv(path))
    raw = raw.withColumn("file", F.input_file_name()).withColumn("_mid", F.monotonically_increasing_id())
    charsets = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(charsets, None)
    try:
        if encoding.upper() not in ("UTF-8", "UTF8"):
            spark.conf.set(charsets, "true")
        raw = materialize(raw, "bulk")
    finally:
        spark.conf.unset(charsets) if before is None else spark.conf.set(charsets, before)
    starts = raw.groupBy("file").agg(F.min("_mid").alias("_first"))
    rows = raw.join(starts, "file").withColumn("row_no", F.col("_mid") - F.col("_first"))
    head = rows.filter("row_no = 0")
    same = F.lit(True)
    for c, h in zip(columns, header, strict=True):
        same = same & F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "^\\x{FEFF}", "").eqNullSafe(F.lit(h))
    if head.filter(~same).limit(1).count():
        raise ValueError("a bulk file does not start with the expected header")
    return rows.filter("row_no > 0").select(*columns, "file", "row_no", F.col("_bad").isNull().alias("shape_ok"))


def bulk_row_valid(shape_ok: Column | None = None) -> Column:
    """Shape rule of a bulk row: 12 cells, 7-8 digit key, known kind, provider present."""
    ok = (F.col("list_key").rlike("^[0-9]{7,8}$") & F.col("kind").isin(*BULK_KINDS)
          & (F.col("provider") != ""))
    return F.coalesce(ok & (F.lit(True) if shape_ok is None else shape_ok), F.lit(False))


def bulk_records(rows: DataFrame, portal: str = "data-go", evidence: str = "data-go-bulk",
                 base: str = "https://www.data.go.kr/data/") -> DataFrame:
    """Valid bulk rows in the registration shape; repeated keys stay separate rows.

    Record numbers restart in every file, so ids and locators carry a key of the
    file: the first eight hex digits of its path's SHA-256.
    """
    suffix = F.lit(None).cast("string")
    for kind, page in BULK_KINDS.items():
        suffix = F.when(F.col("kind") == kind, F.lit(page)).otherwise(suffix)
    # Logical record numbers count the header line, hence the offset.
    number = (F.col("row_no") + 1).cast("string")
    source = F.substring(F.sha2(F.col("file"), 256), 1, 8)
    return normalize_catalog(rows, {
        "id": F.concat(F.lit(f"{portal}-"), source, F.lit("-row-"), number),
        "portal_id": F.lit(portal),
        "dataset_key": F.col("list_key"),
        "title": F.col("title"),
        "provider_id": F.concat(F.lit(f"{portal}-org-"), F.col("provider_code")),
        "provider_name": F.col("provider"),
        "kind": F.col("kind"),
        "url": F.concat(F.lit(base), F.col("list_key"), F.lit("/"), suffix, F.lit(".do")),
        "evidence_id": F.lit(evidence),
        "locator": F.concat(F.lit("csv_record:"), source, F.lit(":"), number),
        "output_raw": F.nullif("outputs", F.lit("")),
        "request_raw": F.nullif("request_vars", F.lit("")),
        "schema_status": F.when(F.coalesce(F.col("outputs"), F.lit("")) != "", F.lit("declared_labels_only"))
        .otherwise(F.lit("schema_not_in_catalog")),
    }, keep={"keywords_raw": "keywords", "service_type": "service_type", "format_raw": "format",
             "update_frequency_raw": "cycle", "row_count_raw": "total_rows", "source_provider_code": "provider_code"})


def normalize_catalog(raw: DataFrame, mapping: Mapping[str, Column], keep: Mapping[str, str] | None = None) -> DataFrame:
    """Map a portal's rows to the registration shape.

    ``mapping`` gives an expression for some of the thirteen columns; the others
    become null.  ``keep`` names source columns that go into ``metadata`` under
    the given key, beside the mapped columns.
    """
    unknown = set(mapping) - set(RECORD_COLUMNS)
    if unknown:
        raise ValueError(f"not registration columns: {sorted(unknown)}")
    cols = [mapping.get(c, F.lit(None)).cast("string").alias(c) for c in RECORD_COLUMNS]
    extra = [F.col(v).alias(k) for k, v in (keep or {}).items()]
    meta = F.to_json(F.struct(*cols, *extra), {"ignoreNullFields": "false"})
    return raw.select(*cols, F.parse_json(meta).alias("metadata"))


def union_catalogs(*parts: DataFrame) -> DataFrame:
    """All portals' registrations in one table; keys are never merged across portals."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def declared_fields(records: DataFrame) -> DataFrame:
    """Declared tokens of each registration: record_id, role, ordinal, name, status."""
    pair = F.explode(F.array(F.struct(F.lit("output").alias("role"), F.col("output_raw").alias("raw")),
                             F.struct(F.lit("request").alias("role"), F.col("request_raw").alias("raw"))))
    t = records.select(F.col("id").alias("record_id"), pair.alias("p")).filter("p.raw is not null")
    return t.select("record_id", F.col("p.role").alias("role"), F.inline(tx.tokens("p.raw"))).select(
        "record_id", "role", "ordinal", F.col("label").alias("name"),
        F.lit("declared_token_unverified").alias("status"))


def precedence_merge(keys: list[str], *newest_first: DataFrame) -> DataFrame:
    """Union of snapshots in which the newest row of a key wins.

    The winner is taken with ``max_by`` so that a hot key is reduced before the
    shuffle instead of being sorted in one task.
    """
    tagged = [d.withColumn("_rank", F.lit(-i)) for i, d in enumerate(newest_first)]
    allrows = tagged[0]
    for d in tagged[1:]:
        allrows = allrows.unionByName(d, allowMissingColumns=True)
    rest = [c for c in allrows.columns if c not in keys and c != "_rank"]
    won = allrows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("_rank")).alias("_w"))
    return won.select(*keys, "_w.*")
