"""Pointers met parent by parent, and the counting step against the listing."""

import json

import pytest
from pyspark.sql import functions as F

from catalith.durable import materialize as write
from catalith.operators import schema_docs as D
from catalith.operators import shared_schemas as S
from catalith.sources.definitions import documents_from_text
from tests.test_shared_schemas import api, docs, listed, ref

NODES = {"x": {"a/b": 1, "a~b": {"y": None}, "": "empty", "sp ace": [1], "q\"u'o": 2, "가": {"나": True}, "a~1b": 4, "$ref": "#/top"}, "top": {"z": 3}, "": {"": 5}}
POINTERS = {"#/x/a~1b": "1", "#/x/a~0b": '{"y":null}', "#/x/a~0b/y": "null", "#/x/": '"empty"', "#/x/sp ace": "[1]", "#/x/q\"u'o": "2",
            "#/x/가/나": "true", "#/x/a~01b": "4", "#/top": '{"z":3}', "#/top/z": "3", "#//": "5", "#/x/sp ace/0": None, "#/x/none": None, "#/none/x": None}


@pytest.mark.parametrize("spelled", ["plain", "indented", "escaped"])
def test_pointers_find_their_nodes(spark, spelled):
    doc = NODES | {"uses": [{"$ref": p} for p in POINTERS] * 2 + [{"other": '"$ref":"#/x/none"', "$ref": "http://e/x"}]}
    text = json.dumps(doc, ensure_ascii=spelled == "escaped", indent=1 if spelled == "indented" else None,
                      separators=(" ,", " : ") if spelled == "indented" else None)
    text = text.replace('"$ref"', '"\\u0024ref"') if spelled == "escaped" else text.replace("#/x/sp", "#\\/x/sp")
    rows = spark.createDataFrame([("d", text), ("bad", '{"$ref":"#/x"'), ("none", None), ("scalar", '"$ref"')], "p string, t string")
    want = sorted((p, n) for p, n in POINTERS.items() if n is not None)
    for keep in (True, False):
        got = D.document_nodes(documents_from_text(rows, "p", "t", keep_text=keep)).select("path", "pointer", F.to_json("node").alias("n")).collect()
        assert sorted((r.pointer, r.n) for r in got) == want and {r.path for r in got} == {"d"}


def test_odd_shapes_count_as_they_are_listed(spark):
    leaf, array = {"type": "string"}, lambda x: {"type": "array", "items": x}
    body = {
        "A": {"properties": {"[]": leaf, "b": {"properties": {"[]": ref("B")}}}, "additionalProperties": {"type": "string"}},
        "B": array(array(ref("C"))), "C": {"allOf": [ref("D"), {"properties": {"[]": leaf, "d": array({"properties": {"e": leaf}})}}], "properties": {"f": ref("Gone")}},
        "D": {"oneOf": [], "type": "object"}, "E": {"properties": {}, "items": {"$ref": "http://e/x"}, "type": "array"}, "F": {"type": "object"},
        "G": {"properties": {"[]": array(leaf), "h": 3, "i": {"$ref": ""}, "j": {"$ref": 7}}}, "H": array({"type": "object"}), "I": {"anyOf": [leaf, array(ref("D"))]}}
    d = docs(spark, *[api(body, ref(k), array(ref(k)), {"properties": {"[]": ref(k)}}, {"allOf": [ref(k), leaf]}) for k in body])
    _, _, want = D.openapi_fields(d)
    got = listed(S.openapi_counts(d))
    assert got == listed(want) and sum(r[4] for r in got) > 10 and sum(r[5] for r in got) > 10


def test_a_round_meets_the_references_of_the_schemas_it_unfolds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(S, "materialize", lambda df, tag: written.append(tag) or write(df, tag))
    chain = {f"S{k}": {"properties": {"l": ref(f"S{k + 1}"), "r": ref(f"S{k + 1}")}} for k in range(12)} | {"S12": {"type": "string"}}
    rows = S.openapi_counts(docs(spark, api(chain, ref("S0")))).filter("output_fields > 0").collect()
    assert [int(r.output_fields) for r in rows] == [2**12]
    assert written.count("shared") == 1


def test_counts_meet_by_document_in_one_shuffle(spark):
    roots, nodes, _ = S.unfold_shared(docs(spark, api({"A": {"properties": {"b": ref("B")}}, "B": {"type": "string"}}, ref("A"))))
    plan = S.document_counts(roots, nodes)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
