import json

from pyspark.sql import functions as F

from catalith.functions.html import table_cells
from catalith.operators import schema_docs as D
from catalith.sources.definitions import documents_from_text


def docs(spark, *objs):
    return documents_from_text(spark.createDataFrame(
        [(f"d{i}", o if isinstance(o, str) else json.dumps(o)) for i, o in enumerate(objs)], "p string, t string"), "p", "t")


def test_openapi_unfolding(spark):
    doc = {"openapi": "3.0", "paths": {"/a/b": {"get": {"summary": "S", "responses": {"200": {
        "content": {"application/json": {"schema": {"$ref": "#/components/schemas/Root"}}}}, "404": {"$ref": "#/components/responses/No"}}},
        "post": {"operationId": "p", "responses": {"200": {"schema": {"type": "string"}}}}}},
        "components": {"schemas": {
            "Root": {"type": "object", "properties": {
                "n": {"type": "integer", "description": "count"}, "이름": {"type": "string"},
                "rows": {"type": "array", "items": {"$ref": "#/components/schemas/Row"}},
                "free": {"type": "object", "additionalProperties": True},
                "tags": {"type": "array", "items": {"type": "string"}},
                "mix": {"allOf": [{"$ref": "#/components/schemas/Row"}, {"properties": {"x": {"title": "X title"}}}]},
                "gone": {"$ref": "#/components/schemas/Missing"}, "far": {"$ref": "http://x/y"}}},
            "Row": {"properties": {"id": {"type": "string"}, "next": {"$ref": "#/components/schemas/Row"}}}},
            "responses": {"No": {"content": {"a/b": {"schema": {"properties": {"msg": {"type": "string"}}}}}}}}}
    f, i, o = D.openapi_fields(docs(spark, doc))
    got = {(r.schema_path, r.datatype, r.status, r.schema_variant) for r in f.collect()}
    assert got == {("n", "integer", "200", None), ("이름", "string", "200", None), ("rows.[].id", "string", "200", None),
                   ("tags", "array", "200", None), ("mix.id", "string", "200", "/allOf/0"),
                   ("mix.x", None, "200", "/allOf/1"), ("msg", "string", "404", None)}
    by = {r.schema_path: r for r in f.collect()}
    assert by["이름"].name_en is None and by["mix.x"].name == "X title"
    assert by["rows.[].id"].locator == "#/components/schemas/Row/properties/id"
    reasons = sorted(r.reason for r in i.collect())
    assert reasons == ["external_schema_reference_not_fetched", "local_schema_reference_missing:#/components/schemas/Missing",
                       "object_without_fixed_properties", "recursive_schema_reference", "recursive_schema_reference",
                       "scalar_response_without_named_field"]
    ops = {r.method: r for r in o.collect()}
    assert ops["GET"].output_fields == 7 and ops["GET"].response_schemas_observed == 2
    assert ops["POST"].status == "definition_unresolved" and ops["POST"].name == "p"


def test_stat_table(spark):
    doc = {"orgId": "101", "tblId": "T1", "classInfoList": [
        {"classNm": "성별", "classEngNm": "sex", "classId": "A", "itmCnt": 2, "itmList": [1, 2]},
        {"classNm": "연령", "classId": "B", "itmCnt": 3, "itmList": [1]}],
        "itemInfo": {"itmCnt": 1, "itmList": [{"scrKor": "인구", "itmId": "m1", "unitNm": "명"}]},
        "periodStr": "M#Y#", "periodInfo": {"periodNm": "기간", "codeM": "M", "nameM": "월", "startM": "2001", "endM": "2002"}}
    other = {**doc, "tblId": "T2"}
    f, info = D.stat_table_fields(docs(spark, doc, other), [("$.orgId", F.lit("101")), ("$.tblId", F.lit("T1"))])
    rows = {(r.role, r.name): r for r in f.collect()}
    assert len(rows) == 4 and {r.path for r in rows.values()} == {"d0"}
    assert rows[("statistical_measure", "인구")].unit == "명"
    assert rows[("statistical_dimension", "성별")].code_list_complete is True
    assert rows[("statistical_dimension", "연령")].code_list_complete is False
    assert {r.path: r.identity_ok for r in info.collect()} == {"d0": True, "d1": False}
    cov = D.dimension_coverage(f).collect()[0]
    assert (cov.declared_codes, cov.observed_codes, cov.all_reconcile) == (5, 3, False)
    assert [r.code for r in D.stat_periods(docs(spark, doc)).collect()] == ["M"]


def test_tables_rowspan_glossary(spark):
    html = ("<table><caption>용어해설</caption><thead><tr><th>영문</th><th>국문</th><th>설명</th></tr></thead><tbody>"
            "<tr><td>a</td><td>가</td><td>d1</td></tr><tr><td>b</td><td>나</td></tr></tbody></table>"
            "<table><caption>codes</caption><thead><tr><th>x</th><th>y</th></tr></thead><tbody>"
            "<tr><td rowspan='2'>G</td><td>1</td></tr><tr><td>2</td></tr><tr><td>H</td><td>3</td></tr></tbody></table>"
            "<table><caption>bad</caption><tr><td rowspan='5'>z</td></tr></table>")
    cells = table_cells(spark.createDataFrame([(1, html)], "id int, html string"), ["id"], "html")
    f, i = D.table_fields(cells, ["id"], {"name_en": "영문", "name": "국문", "description": "설명"}, "용어해설")
    assert [(r.name_en, r.name, r.description, r.locator) for r in f.collect()] == [("a", "가", "d1", "table[0].tbody.tr[0]")]
    assert [(r.row_no, r.issue) for r in i.collect()] == [(1, "unexpected_row_width")]
    logical, issues = D.expand_rowspan(cells.filter("caption <> '용어해설'"), ["id"])
    got = sorted((r.row_no, r.col, r.text) for r in logical.collect())
    assert got == [(0, 0, "G"), (0, 1, "1"), (1, 0, "G"), (1, 1, "2"), (2, 0, "H"), (2, 1, "3")]
    assert [r.table_no for r in issues.collect()] == [2]
    assert [(r.term, r.definition) for r in D.glossary_terms(cells, ["id"], "용어해설").collect()] == [("b", "나")]


def test_previews_axis_pairs(spark):
    h, s = D.preview_headers(docs(
        spark, {"numberOfCells": 2, "listHead": [["a", "b"]], "listRow": []},
        {"numberOfCells": 0, "listHead": None, "listRow": None}, {"numberOfCells": 1, "listHead": "x", "listRow": []}))
    assert sorted((r.value, r.locator) for r in h.collect()) == [("a", "listHead[0][0]"), ("b", "listHead[0][1]")]
    assert [r.status for r in s.orderBy("path").collect()] == [
        "preview_header_candidates_observed", "preview_header_empty", "preview_parse_unresolved"]
    it, iss = D.axis_items(docs(spark, {"dataset": [
        {"id": "ds_rowItem", "rows": [{"ROW_CD": "1", "ROW_NM": "r"}, {"ROW_CD": "", "ROW_NM": "q"}]},
        {"id": "ds_colItem", "rows": [{"DB_COL_NM": "c", "COL_NM": "col"}]}, {"id": "other", "rows": []}]}))
    assert sorted((r.code, r.role) for r in it.collect()) == [("1", "statistical_row_item"), ("c", "statistical_column_item")]
    assert sorted((r.issue, r.locator) for r in iss.collect()) == [
        ("item_without_code_or_name", "/dataset/0/rows/1"), ("unknown_item_dataset", "/dataset/2")]
    df = spark.createDataFrame([(1, ["a", "A", "", ""]), (2, ["", "m", "b", ""])], "id int, cells array<string>")
    f, bad = D.unpivot_pairs(df, ["id"], "cells")
    assert sorted((r.id, r.name_en, r.name) for r in f.collect()) == [(1, "a", "A"), (2, "b", "b")]
    assert [(r.id, r.meaning) for r in bad.collect()] == [(2, "m")]


def test_openapi_deep_and_chained_references(spark):
    doc = {"openapi": "3.0", "paths": {"/a": {"parameters": [{"name": "p"}], "get": {
        "parameters": [{"name": "q"}], "requestBody": {"content": {}}, "responses": {
            "200": {"$ref": "#/components/responses/A"}, "400": {"$ref": "#/components/responses/Loop"},
            "401": {"$ref": "http://x/y"}, "402": {"$ref": "#/components/responses/None"},
            "500": {"schema": {"properties": {"in": {"$ref": "#/components/schemas/S/properties/a~1b"}}}}}}}},
        "components": {
            "schemas": {"S": {"properties": {"a/b": {"properties": {"deep": {"type": "string"}}}}},
                        "Open": {"additionalProperties": {}, "properties": {"z": {"type": "string"}}}},
            "responses": {"A": {"$ref": "#/components/responses/B"}, "B": {"$ref": "#/components/responses/C"},
                          "C": {"schema": {"$ref": "#/components/schemas/Open"}},
                          "Loop": {"$ref": "#/components/responses/Pool"}, "Pool": {"$ref": "#/components/responses/Loop"}}}}
    f, i, _ = D.openapi_fields(docs(spark, doc))
    assert sorted((r.status, r.schema_path) for r in f.collect()) == [("200", "z"), ("500", "in.deep")]
    assert sorted(r.reason for r in i.collect()) == [
        "external_schema_reference_not_fetched", "local_schema_reference_missing:#/components/responses/None",
        "recursive_response_reference"]
    given = D.openapi_parameters(docs(spark, doc)).select("operation", "role", "ordinal", F.to_json("definition").alias("d"))
    assert sorted(tuple(r) for r in given.collect()) == [
        ("openapi:GET:/a", "request_body", 0, '{"content":{}}'), ("openapi:GET:/a", "request_parameter", 0, '{"name":"p"}'),
        ("openapi:GET:/a", "request_parameter", 1, '{"name":"q"}')]


def test_openapi_depth_has_no_limit_of_its_own(spark):
    node = {"type": "string"}
    for k in range(42):
        node = {"properties": {f"n{k}": node}}
    doc = {"openapi": "3.0", "paths": {"/a": {"get": {"responses": {"200": {"schema": node}}}}}}
    f, i, _ = D.openapi_fields(docs(spark, doc))
    assert [r.schema_path.count(".") for r in f.collect()] == [41] and i.count() == 0
