from hashlib import sha256
import json

import pytest
from pyspark.sql import functions as F

from catalith.operators import lexical as lx
from catalith.operators import reconcile as rc
from catalith.sinks import export as xp
from catalith.sources import catalog as ct
from catalith.sources import definitions as df_
from catalith.sources import institutions as inst
from catalith.sources import vocabulary as vc


def bulk(tmp_path, rows, header=ct.BULK_HEADER):
    lines = [",".join(header)] + [",".join(r) for r in rows]
    (tmp_path / "bulk.csv").write_bytes("\r\n".join(lines).encode("cp949"))
    return str(tmp_path / "bulk.csv")


def test_bulk_csv_to_records(spark, tmp_path):
    good = lambda k, kind="FILE": [k, "목록", '"a,b"', "기관", "C1", kind, "svc", "CSV", '"x,y"', '"o1, ,o2"', "월", "10"]
    rows = [["bad"], good("1234567"), good("12345678", "API"), ["cont"], ["cont2"], good("1234567", "STD"), good("12x")]
    raw = ct.read_bulk_csv(spark, bulk(tmp_path, rows))
    split = rc.quarantine_split(raw, "row_no", ct.bulk_row_valid(F.col("shape_ok")))
    reasons = {r.row_no: r.quarantine_reason for r in split.collect()}
    bad, near = "invalid_record_shape_or_identifiers", "followed_by_malformed_continuation"
    # Row 2 precedes a malformed run, row 6 precedes row 7; the header is not implicated by row 1.
    assert reasons == {1: bad, 2: None, 3: near, 4: bad, 5: bad, 6: near, 7: bad}
    acc = rc.accounting_identity(split).collect()[0]
    assert (acc.source_rows, acc.imported, acc.invalid, acc.implicated, acc.balanced) == (7, 1, 4, 2, True)
    rec = ct.bulk_records(split.filter("quarantine_reason is null")).collect()[0]
    key = sha256(split.first().file.encode()).hexdigest()[:8]
    assert rec.id == f"data-go-{key}-row-3" and rec.url == "https://www.data.go.kr/data/1234567/fileData.do"
    assert rec.locator == f"csv_record:{key}:3" and rec.provider_id == "data-go-org-C1"
    toks = ct.declared_fields(ct.bulk_records(split.filter("quarantine_reason is null"))).collect()
    assert sorted((t.role, t.ordinal, t.name) for t in toks) == [
        ("output", 1, "o1"), ("output", 3, "o2"), ("request", 1, "x"), ("request", 2, "y")]
    with pytest.raises(ValueError):
        ct.read_bulk_csv(spark, bulk(tmp_path, rows, header=("x", *ct.BULK_HEADER[1:])))


def test_bulk_ids_of_two_files_differ(spark, tmp_path):
    row = ["1234567", "목록", "a", "기관", "C1", "FILE", "svc", "CSV", "x", "o1", "월", "10"]
    for d in ("one", "two"):
        (tmp_path / d).mkdir()
        bulk(tmp_path / d, [row])
    before = spark.conf.get("spark.sql.legacy.javaCharsets", None)
    ids = [r.id for r in ct.bulk_records(ct.read_bulk_csv(spark, f"{tmp_path}/*/bulk.csv")).collect()]
    assert len(ids) == len(set(ids)) == 2 and spark.conf.get("spark.sql.legacy.javaCharsets", None) == before


def test_documents_receipts_jsonl(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"portal_id": "p", "dataset_key": "k", "evidence_id": "e", "source_url": "u",
                                                 "fields": [{"name": "n", "unit": "-"}, {"name": "", "name_en": "x", "role": "response_control"}]}))
    (tmp_path / "b.json").write_text("{broken")
    docs = df_.read_documents(spark, str(tmp_path / "*.json"))
    f = df_.definition_fields(docs).orderBy("ordinal").collect()
    assert [(r.ordinal, r.name, r.unit, r.name_en, r.role) for r in f] == [
        (1, "n", None, None, "documented_column"), (2, None, None, "x", "response_control")]
    assert docs.filter("error is not null").count() == 1
    rec = spark.createDataFrame([("r1", "p", "k", "X"), ("r2", "p", "k", "Y"), ("r3", "q", "k", "X")],
                                "id string, portal_id string, dataset_key string, kind string")
    assert df_.attach_definitions(df_.definition_fields(docs), rec).count() == 4
    assert df_.unmatched_documents(df_.definition_fields(docs), rec.filter("portal_id = 'q'")).count() == 1
    out = str(tmp_path / "out")
    xp.write_jsonl(rec, out, ["id"])
    back = df_.read_jsonl(spark, out, "id string, portal_id string, dataset_key string, kind string")
    assert rc.table_difference(rec, back).count() == 0


def test_vocabulary(spark, tmp_path):
    rows = spark.createDataFrame([
        ("EntityType", "person", "사람", "population", "사람", "a·b"), ("Unit", "person", "명", "population", "명", "c"),
        ("Unit", "thousand", "천명", "population", "천명|천 명", ""), ("Measure", "rate", "실업률", "employment", "실업률", "")], vc.ROW_SCHEMA)
    v = vc.concept_vocabulary(vc.topic_rows(spark).unionByName(rows), spark.createDataFrame([("person", "thousand")], "a string, b string"))
    assert v.concepts.count() == 20 and len(vc.FACETS) == 8
    rel = {(r.source, r.predicate, r.target) for r in v.relationships.collect()}
    assert ("unit:person", "distinguishFrom", "unit:thousand") in rel and len(rel) == 5
    # One alias may stand for several kinds.
    assert {r.concept_id for r in v.aliases.filter("alias = '인구'").collect()} == {"topic:population"}
    rows.coalesce(1).write.option("header", True).option("sep", "\t").csv(str(tmp_path / "v.tsv"))
    assert vc.read_rows(spark, str(tmp_path / "v.tsv")).count() == 4


def test_matching_rules(spark):
    al = spark.createDataFrame([("가구", "measure:household", "Measure"), ("가구", "topic:population", "Topic"), ("%", "unit:percent", "Unit"),
                                ("행정표준코드", "identifierscheme:school-code", "IdentifierScheme"), ("PM10", "measure:dust", "Measure")],
                               "alias string, concept_id string, kind string")
    base = dict(record_id="r", evidence_id="e", ordinal=1, locator=None, source_url=None, description=None, datatype=None)
    def item(portal, kind, label=None, en=None, unit=None, control=False):  # noqa: E306
        return {**base, "portal_id": portal, "kind": kind, "label": label, "name_en": en, "unit": unit, "role": "x", "is_control": control}
    cases = [(item("p", "catalog_label", " 가구 "), ["measure:household", "topic:population"]),
             (item("p", "documented_field", "가구", unit="%"), ["measure:household", "unit:percent"]),
             (item("p", "declared_output", "가구", unit="%"), ["measure:household"]), (item("p", "documented_field", "%"), []),
             (item("p", "documented_field", "행정표준코드"), []), (item("neis", "documented_field", "행정표준코드"), ["identifierscheme:school-code"]),
             (item("hrfco", "documented_field", None, "RF"), ["measure:precipitation"]), (item("p", "documented_field", None, "RF"), []),
             (item("hrfco", "catalog_label", None, "RF"), []), (item("p", "documented_field", "PM10", "PM10"), ["measure:dust"]),
             (item("hrfco", "documented_field", "가구", "WL", control=True), [])]
    schema = ("record_id string, evidence_id string, ordinal int, locator string, source_url string, description string, datatype string, "
              "portal_id string, kind string, label string, name_en string, unit string, role string, is_control boolean, n int")
    df = spark.createDataFrame([{**c, "n": i} for i, (c, _) in enumerate(cases)], schema)
    got = {r.n: r.concept_ids for r in lx.match_items(df, al).collect()}
    assert got == {i: w for i, (_, w) in enumerate(cases)}


def test_record_terms(spark):
    meta = {"title": "T", "category_raw": " c ", "category_path_raw": "root > a > T", "keywords_raw": "k1, ,k2",
            "source_catalog_record": {"topCateNm": "top", "kwrd_one": "k1"}, "source_category": ""}
    df = spark.createDataFrame([(json.dumps(meta),)], "j string").select(F.explode(lx.record_terms(F.parse_json("j"))).alias("t"))
    assert [tuple(r.t) for r in df.collect()] == [
        ("source_category", "c", "$.category_raw"), ("source_category", "a", "$.category_path_raw::segment[1]"),
        ("source_category", "top", "$.source_catalog_record.topCateNm"),
        ("keyword_token_candidate", "k1", "$.keywords_raw::comma_token[0]"), ("keyword_token_candidate", "k2", "$.keywords_raw::comma_token[2]"),
        ("keyword_token_candidate", "k1", "$.source_catalog_record.kwrd_one")]


def test_sites_and_carry(spark):
    df = spark.createDataFrame([("a", "https://www.X.kr/"), ("b", "x.kr"), ("c", "http://x.kr/p/"), ("d", "bad url"), ("e", None)], "id string, homepage string")
    t, members = inst.dedupe_targets(df)
    assert {(r.site_key, r.institutions, r.scheme_assumed) for r in t.collect()} == {("x.kr", 2, False), ("x.kr/p", 1, False)}
    assert members.count() == 3
    roster = spark.createDataFrame([(1, "R1", True), (2, "x", False), (3, "R2", True), (4, "y", False)], "pos int, label string, top boolean")
    got = inst.carry_parent(roster.withColumn("l", F.lit("L")), F.col("top"), "label", "pos", "l")
    assert {r.label: r.parent_name for r in got.collect()} == {"R1": "R1", "x": "R1", "R2": "R2", "y": "R2"}


def test_shards_round_trip(spark, tmp_path):
    df = spark.range(1, 1201).select(F.concat(F.lit("i"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("k"), (F.col("id") * 2).alias("v"))
    path = str(tmp_path / "shards")
    man = xp.export_shards(df, path, ["k"], "k", rows=500)
    rows = {r.shard: r for r in man.collect()}
    assert [(rows[i].rows, rows[i].first, rows[i].last) for i in range(3)] == [(500, "i00001", "i00500"), (500, "i00501", "i01000"), (200, "i01001", "i01200")]
    assert xp.verify_shards(spark, path, man, "k", ["k", "v"]).count() == 0
    forged = man.withColumn("sha256", F.when(F.col("shard") == 1, F.lit("x")).otherwise(F.col("sha256")))
    assert [r.shard for r in xp.verify_shards(spark, path, forged, "k", ["k", "v"]).collect()] == [1]


def test_receipts_and_snapshots(spark, tmp_path):
    rec = spark.createDataFrame([(f"e{i}", f"https://x/?key=s{i}", "fetched", "h") for i in range(50)], "id string, requested_url string, status string, sha256 string").withColumn(
        "retrieved_at", F.current_timestamp()).withColumn("cookie", F.lit("secret"))
    path = str(tmp_path / "receipts")
    xp.export_receipts(rec, path)
    one = xp.read_receipt(spark, path, "e7")
    assert [r.requested_url for r in one.collect()] == ["https://x/?key=%5BREDACTED%5D"] and "cookie" not in one.columns
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    root = str(tmp_path / "snap")
    with pytest.raises(ValueError):
        xp.read_snapshot(spark, root)
    xp.snapshot_swap(spark.range(3), root)
    xp.snapshot_swap(spark.range(5), root)
    assert xp.read_snapshot(spark, root).count() == 5


def test_receipts_per_file_and_per_line(spark, tmp_path):
    from catalith.sources import definitions

    (tmp_path / "lines.json").write_text('{"id": "a"}\n{"id": "b"}\n')
    (tmp_path / "whole.json").write_text('{\n "id": "c"\n}\n')
    assert sorted(r["id"] for r in definitions.read_receipts(spark, str(tmp_path)).collect()) == ["a", "b", "c"]


def test_unreadable_receipts_lose_nothing(spark, tmp_path):
    files = {"lines": '{"id": "a"}\n{"id": "b", "bytes": 3}\n{"id": "c", "by', "first": '{"id": "x\n{"id": "d"}\n\n', "pretty": '{\n  "id": "e",\n  "status": "{"\n}\n',
             "two": '{\n "id": "f"\n}\n{\n "id": "g"\n}', "blank": "\n \n", "none": "not json", "own": '{"id": "h", "error": "404"}'}
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows = df_.read_receipts(spark, str(tmp_path)).collect()
    good = {r["id"]: r["error"] for r in rows if r["id"]}
    assert good == {"a": None, "b": None, "d": None, "e": None, "h": "404"}
    bad = sorted(r["error"] for r in rows if not r["id"])
    assert bad == sorted("unreadable receipt: " + t for t in ('{"id": "c", "by', '{"id": "x', files["two"], "not json"))
