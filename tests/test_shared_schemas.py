"""Counts of shared schemas against the full listing, and a chain too wide to list."""

import json
import random

from catalith.operators import schema_docs as D
from catalith.operators import shared_schemas as S
from catalith.sources.definitions import documents_from_text


def docs(spark, *objs):
    return documents_from_text(spark.createDataFrame([(f"d{i}", json.dumps(o)) for i, o in enumerate(objs)], "p string, t string"), "p", "t")


def api(schemas, *roots, **responses):
    given = {str(200 + i): {"content": {"application/json": {"schema": r}}} for i, r in enumerate(roots)} | responses
    return {"openapi": "3.0", "paths": {"/a": {"get": {"responses": given}}, "/none": {"post": {}}}, "components": {"schemas": schemas}}


def ref(name):
    return {"$ref": f"#/components/schemas/{name}"}


def varied(rng):
    def schema(depth, k):
        kind = rng.randrange(9)
        if kind < 3 and k < 7:
            return ref(f"S{rng.randrange(k + 1, 8)}")
        if kind == 3 and depth:
            return {"type": "array", "items": schema(depth - 1, k)}
        if kind == 4 and depth:
            return {rng.choice(["allOf", "oneOf", "anyOf"]): [schema(depth - 1, k) for _ in range(2)]}
        if kind in (5, 6) and depth:
            return {"properties": {f"p{i}": schema(depth - 1, k) for i in range(rng.randrange(1, 4))}} | (
                {"additionalProperties": rng.choice([True, False, {"type": "string"}])} if kind == 6 else {})
        return rng.choice([{"type": "string"}, {"type": "object"}, ref("Missing"), {"$ref": "http://x/y"}, "text", {}])
    body = {f"S{k}": schema(3, k) for k in range(8)}
    return api(body, *[s if isinstance(s, dict) else {} for s in (schema(2, 0), ref("S0"), {"type": "array", "items": ref("S1")})],
               **{"404": {"$ref": "#/components/responses/None"}})


def listed(frame):
    return sorted((r.path, r.operation, r.name, r.response_schemas_observed, int(r.output_fields), int(r.unresolved_schema_parts), r.status)
                  for r in frame.collect())


def test_counts_equal_the_listing(spark):
    rng = random.Random(5)
    loop = {"R": {"properties": {"a": {"type": "string"}, "r": ref("Q")}}, "Q": {"properties": {"q": ref("R"), "z": {"type": "string"}}}}
    d = docs(spark, *[varied(rng) for _ in range(40)], api(loop, ref("R"), ref("Q")), api({}), {"openapi": "3.0"})
    _, _, want = D.openapi_fields(d)
    got, want = listed(S.openapi_counts(d)), listed(want)
    assert got == want and sum(r[4] for r in got) > 50


def test_chain_that_uses_each_schema_twice(spark):
    chain = {f"S{k}": {"properties": {"l": ref(f"S{k + 1}"), "r": ref(f"S{k + 1}")}} for k in range(25)} | {"S25": {"type": "string"}}
    rows = S.openapi_counts(docs(spark, api(chain, ref("S0")))).filter("output_fields > 0").collect()
    assert [(int(r.output_fields), int(r.unresolved_schema_parts)) for r in rows] == [(2**25, 0)]


def test_documents_without_schemas(spark):
    assert S.openapi_counts(docs(spark, {"openapi": "3.0"}, {})).count() == 0
    assert listed(S.openapi_counts(docs(spark, {"paths": {"/x": {"get": {"operationId": "o"}}}}))) == [
        ("d0", "openapi:GET:/x", "o", 0, 0, 0, "definition_unresolved")]
