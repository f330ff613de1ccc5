"""Column definitions out of stored documents: tables, statistical JSON, OpenAPI."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.sources.definitions import json_array_length, json_items, json_value

# The HTTP methods of an operation.
METHODS = ("get", "post", "put", "patch", "delete", "options", "head", "trace")


def table_fields(cells: DataFrame, keys: Sequence[str], roles: dict[str, str], caption: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(fields, issues) of documentation tables, read by header name.

    ``cells`` comes from ``table_cells``; ``roles`` maps an output column to the
    header text that labels it.  Rows whose cell count differs from the header's
    are issues.  Header positions are looked up, never assumed.
    """
    t = cells.filter(F.col("caption") == caption) if caption else cells
    by_table = [*keys, "table_no"]
    head = t.filter("in_head")
    width = head.groupBy(*by_table).agg(F.count(F.lit(1)).alias("_width"))
    wanted = F.lit(None).cast("string")
    for out, text in roles.items():
        wanted = F.when(F.col("text") == text, F.lit(out)).otherwise(wanted)
    place = head.withColumn("_role", wanted).filter("_role is not null").select(*by_table, "cell_no", "_role")
    rows = t.filter("not in_head").join(width, by_table)
    per_row = rows.groupBy(*by_table, "row_no").agg(F.count(F.lit(1)).alias("_cells"), F.max("_width").alias("_width"))
    good = per_row.filter("_cells = _width").select(*by_table, "row_no")
    issues = per_row.filter("_cells <> _width").select(
        *by_table, "row_no", F.lit("unexpected_row_width").alias("issue"), F.col("_cells").alias("cells"))
    vals = rows.join(good, [*by_table, "row_no"], "left_semi").join(place, [*by_table, "cell_no"])
    fields = vals.groupBy(*by_table, "row_no").agg(*[
        F.max(F.when(F.col("_role") == r, F.col("text"))).alias(r) for r in roles])
    return fields.withColumn("locator", F.format_string("table[%d].tbody.tr[%d]", "table_no", "row_no")), issues


def expand_rowspan(cells: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(logical cells, issues) of a table with vertically merged cells.

    A cell that runs past the table or spans columns is an issue; it is never
    stretched into invented rows.  The column of a cell is its position plus the
    number of earlier-row spans that cover places at or before it; since a span
    shifts later cells, columns settle row by row inside each table's own row
    array.
    """
    by = [*keys, "table_no"]
    body = cells.filter("not in_head")
    bad = (F.col("colspan") != 1) | (F.col("rowspan") < 1) | (F.col("row_no") + F.col("rowspan") > F.col("n_rows"))
    issues = body.filter(bad).select(*by, "row_no", "cell_no", F.lit("unsupported_or_out_of_bounds_span").alias("issue"))
    row = F.struct("row_no", "cell_no", "rowspan", "text")
    # One HTML table is one document fragment; its cells already came from one value.
    tables = body.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("_cells"))
    empty = F.from_json(F.lit("[]"), "array<struct<row_no:int,col:int,until:int,text:string,src:int>>")

    def place(acc: Column, c: Column) -> Column:
        taken = F.transform(F.filter(acc, lambda p: (p["row_no"] <= c["row_no"]) & (p["until"] > c["row_no"])),
                            lambda p: p["col"])
        free = F.array_except(F.sequence(F.lit(0), F.size(acc)), taken)
        return F.array_append(acc, F.struct(
            c["row_no"].cast("int").alias("row_no"), F.array_min(free).cast("int").alias("col"),
            (c["row_no"] + c["rowspan"]).cast("int").alias("until"), c["text"].alias("text"),
            c["cell_no"].cast("int").alias("src")))

    placed = tables.select(*by, F.inline(F.aggregate("_cells", empty, place)))
    logical = placed.select(*by, "col", "text", F.col("row_no").alias("source_row"), "src",
                            F.explode(F.sequence("row_no", F.col("until") - 1)).alias("row_no"))
    broken = issues.select(*by).distinct()
    logical = logical.join(broken, by, "left_anti")
    return logical.select(*by, "row_no", "col", "text", "source_row", F.col("src").alias("source_cell")), issues


def glossary_terms(cells: DataFrame, keys: Sequence[str], caption: str) -> DataFrame:
    """(term, definition, locator) from two-cell rows of the glossary table."""
    rows = cells.filter((F.col("caption") == caption)).groupBy(*keys, "table_no", "in_head", "row_no").agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or(F.col("tag") == "td").alias("_td"),
        F.max(F.when(F.col("cell_no") == 0, F.col("text"))).alias("term"),
        F.max(F.when(F.col("cell_no") == 1, F.col("text"))).alias("definition"))
    return rows.filter((F.col("_n") == 2) & F.col("_td") & (F.col("term") != "")).select(
        *keys, "term", "definition", F.format_string("table[%d].tr[%d]", "table_no", "row_no").alias("locator"),
        F.lit("not_approved").alias("mapping_status"))


def unpivot_pairs(rows: DataFrame, keys: Sequence[str], cells: str) -> tuple[DataFrame, DataFrame]:
    """(fields, issues) of rows that hold two (name, meaning) pairs.

    Blank pairs are skipped; a meaning without a name is an issue.
    """
    def at(i: int) -> Column:
        return F.trim(F.coalesce(F.get(F.col(cells), F.lit(i)), F.lit("")))

    pairs = rows.select(*keys, F.inline(F.array(*[F.struct(
        F.lit(s).alias("cell_start"), at(s).alias("name_en"), at(s + 1).alias("meaning")) for s in (0, 2)])))
    used = pairs.filter("name_en <> '' or meaning <> ''")
    fields = used.filter("name_en <> ''").select(
        *keys, "cell_start", "name_en", F.coalesce(F.nullif("meaning", F.lit("")), "name_en").alias("name"), "meaning")
    return fields, used.filter("name_en = ''").withColumn("issue", F.lit("missing_output_variable_name"))


def stat_table_fields(docs: DataFrame, expected: Sequence[tuple[str, Column]] = ()) -> tuple[DataFrame, DataFrame]:
    """(fields, documents) of statistical-table JSON.

    Fields are dimensions, measures (with their unit) and at most one period row
    per document.  The documents carry declared and observed counts, whether
    they agree, and ``identity_ok``: every (path, value) in ``expected`` holds.
    Documents that fail the identity guard give no fields.
    """
    same = F.lit(True)
    for path, want in expected:
        same = same & F.coalesce(json_value("doc", path) == want, F.lit(False))
    base = docs.withColumn("identity_ok", same)
    ok = base.filter("identity_ok")
    dims = ok.select("path", F.posexplode(json_items("doc", "$.classInfoList")).alias("pos", "d")).select(
        "path", F.lit("statistical_dimension").alias("role"), json_value("d", "$.classNm").alias("name"),
        json_value("d", "$.classEngNm").alias("name_en"), json_value("d", "$.classId").alias("code"),
        F.lit(None).cast("string").alias("unit"),
        F.format_string("classInfoList[%d]", "pos").alias("locator"),
        json_value("d", "$.itmCnt", "long").alias("declared_codes"),
        json_array_length("d", "$.itmList").cast("long").alias("observed_codes"))
    meas = ok.select("path", F.posexplode(json_items("doc", "$.itemInfo.itmList")).alias("pos", "m")).select(
        "path", F.lit("statistical_measure").alias("role"), json_value("m", "$.scrKor").alias("name"),
        json_value("m", "$.scrEng").alias("name_en"), json_value("m", "$.itmId").alias("code"),
        json_value("m", "$.unitNm").alias("unit"), F.format_string("itemInfo.itmList[%d]", "pos").alias("locator"))
    named = stat_periods(ok).groupBy("path", "period_name").agg(F.count(F.lit(1)).alias("_n"))
    per = named.select("path", F.lit("statistical_period").alias("role"), F.col("period_name").alias("name"),
                       F.lit("period").alias("code"), F.lit("periodInfo").alias("locator"))
    fields = dims.unionByName(meas, allowMissingColumns=True).unionByName(per, allowMissingColumns=True).withColumn(
        "code_list_complete", F.col("declared_codes") == F.col("observed_codes"))
    declared = json_value("doc", "$.itemInfo.itmCnt", "long")
    observed = json_array_length("doc", "$.itemInfo.itmList").cast("long")
    info = base.select("path", "identity_ok", json_array_length("doc", "$.classInfoList").alias("dimensions"),
                       declared.alias("declared_measures"), observed.alias("observed_measures"),
                       declared.eqNullSafe(observed).alias("measure_list_complete"))
    return fields, info


def stat_periods(docs: DataFrame) -> DataFrame:
    """Periods a table is published for: code, name, start and end.

    The codes come ``#``-separated; a code without its entry is skipped.
    """
    info = json_value("doc", "$.periodInfo", "map<string,variant>")
    code = docs.select("path", info.alias("_i"), json_value("doc", "$.periodInfo.periodNm").alias("period_name"),
                       F.explode(F.split(F.coalesce(json_value("doc", "$.periodStr"), F.lit("")), "#")).alias("code"))

    def part(p: str) -> Column:
        return json_value(F.try_element_at("_i", F.concat(F.lit(p), "code")), "$")

    return code.filter("code <> ''").select(
        "path", "period_name", "code", part("code").alias("_present"), part("name").alias("name"),
        part("start").alias("start"), part("end").alias("end")).filter(
        F.coalesce("_present", F.lit("")) != "").drop("_present")


def dimension_coverage(fields: DataFrame) -> DataFrame:
    """Whether all dimension code lists of a document are complete."""
    return fields.filter("role = 'statistical_dimension'").groupBy("path").agg(
        F.count(F.lit(1)).alias("dimensions"), F.coalesce(F.sum("declared_codes"), F.lit(0)).alias("declared_codes"),
        F.sum("observed_codes").alias("observed_codes"),
        F.bool_and(F.coalesce("code_list_complete", F.lit(False))).alias("all_reconcile"))


def preview_headers(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(headers, status) of file previews.

    Header cells carry a (row, cell) locator.  A preview with zero cells and null
    lists is empty; one of another shape, or with a non-text header, is
    unresolved and gives no headers.
    """
    cells = json_value("doc", "$.numberOfCells", "int")
    head = json_value("doc", "$.listHead", "array<array<string>>")
    body = json_value("doc", "$.listRow", "array<variant>")
    empty = (cells == 0) & json_value("doc", "$.listHead").isNull() & json_value("doc", "$.listRow").isNull()
    shaped = cells.isNotNull() & head.isNotNull() & body.isNotNull()
    nonblank = F.exists(head, lambda r: F.size(r) > 0)
    d = docs.select(
        "path", head.alias("_head"), F.when(F.coalesce(empty, F.lit(False)), F.lit("preview_header_empty"))
        .when(~shaped, F.lit("preview_parse_unresolved"))
        .when(nonblank, F.lit("preview_header_candidates_observed"))
        .otherwise(F.lit("preview_header_empty")).alias("status"))
    ok = d.filter("status = 'preview_header_candidates_observed'")
    headers = ok.select("path", F.posexplode("_head").alias("header_row", "_r")).select(
        "path", "header_row", F.posexplode("_r").alias("cell", "value")).withColumn(
        "locator", F.format_string("listHead[%d][%d]", "header_row", "cell"))
    return headers, d.select("path", "status")


def axis_items(docs: DataFrame, row_set: str = "ds_rowItem", col_set: str = "ds_colItem") -> tuple[DataFrame, DataFrame]:
    """(items, issues): row and column items of a report form.

    Items without a code or a name, and unknown item sets, are issues.
    """
    sets = docs.select("path", F.posexplode(json_items("doc", "$.dataset")).alias("set_no", "s")).withColumn(
        "set_id", json_value("s", "$.id"))
    known = F.col("set_id").isin(row_set, col_set)
    unknown = sets.filter(~F.coalesce(known, F.lit(False))).select(
        "path", F.lit("unknown_item_dataset").alias("issue"), F.format_string("/dataset/%d", "set_no").alias("locator"))
    rows = sets.filter(known).select("path", "set_no", "set_id", F.posexplode(json_items("s", "$.rows")).alias("row_no", "r"))
    is_row = F.col("set_id") == row_set
    code = F.when(is_row, json_value("r", "$.ROW_CD")).otherwise(json_value("r", "$.DB_COL_NM"))
    name = F.when(is_row, json_value("r", "$.ROW_NM")).otherwise(json_value("r", "$.COL_NM"))
    flat = rows.select("path", code.alias("code"), name.alias("name"),
                       F.when(is_row, F.lit("statistical_row_item")).otherwise(F.lit("statistical_column_item")).alias("role"),
                       F.format_string("/dataset/%d/rows/%d", "set_no", "row_no").alias("locator"))
    whole = (F.coalesce("code", F.lit("")) != "") & (F.coalesce("name", F.lit("")) != "")
    issues = flat.filter(~whole).select("path", F.lit("item_without_code_or_name").alias("issue"), "locator")
    return flat.filter(whole), unknown.unionAll(issues)


# --- OpenAPI response fields -------------------------------------------------

def _members(v: Column) -> Column:
    """Object members as array of (key, value); empty for anything else."""
    m = F.try_variant_get(v, "$", "map<string,variant>")
    return F.coalesce(F.map_entries(m), F.array().cast("array<struct<key:string,value:variant>>"))


def _escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def _unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~"))


def document_nodes(docs: DataFrame) -> DataFrame:
    """Nodes that the local ``$ref`` of a document name: (path, pointer, node).

    Only pointers that occur are resolved, each member by member to any depth;
    arrays are not stepped into.  Pointers without a node give no row.
    Pointers of one parent share the steps to it, so its members are copied once.
    """
    # The document's text is only searched for pointers; those with escapes are read back as JSON.  A kept text is searched
    # as it came, unless escapes may spell a ``$ref`` or the start of a pointer.
    text = F.to_json("doc")
    if "_text" in docs.columns:
        text = F.when(F.col("_text").rlike(r"\\[u/]"), text).otherwise(F.col("_text"))
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r'"\$ref"[ \t\r\n]*:[ \t\r\n]*("#/(?:[^"\\]++|\\.)*+")'), F.lit(1)))
    texts = F.array_distinct(F.transform(found, lambda t: F.when(F.contains(t, F.lit("\\")), F.from_json(
        F.concat(F.lit('{"p":'), t, F.lit("}")), "p string")["p"]).otherwise(F.substr(t, F.lit(2), F.length(t) - 2))))
    last = F.transform(texts, lambda p: F.struct(p.alias("pointer"), F.substring_index(p, "/", -1).alias("last")))
    pointers = F.transform(last, lambda p: F.struct(
        p["pointer"].alias("pointer"), F.substr(p["pointer"], F.lit(1), F.length(p["pointer"]) - F.length(p["last"]) - 1).alias("parent"),
        _unescape(p["last"]).alias("name")))

    def members(p: Column) -> Column:
        return F.try_variant_get(p, "$", "map<string,variant>")

    names = F.slice(F.split("parent", "/"), F.lit(2), F.size(F.split("parent", "/")))
    at = F.aggregate(names, F.col("doc"), lambda at, name: F.try_element_at(members(at), _unescape(name)))
    # Each explode ends a projection: what is found for a parent is not found again for its pointers.
    by_doc = docs.select("path", "doc", F.explode(F.array(pointers)).alias("pointers"))
    by_parent = by_doc.select("path", "doc", "pointers", F.explode(F.array_distinct(F.col("pointers.parent"))).alias("parent"))
    inside = by_parent.select("path", "parent", "pointers", F.explode(F.array(members(at))).alias("members"))
    return inside.select("path", F.inline(F.transform(F.filter("pointers", lambda p: p["parent"] == F.col("parent")), lambda p: F.struct(
        p["pointer"].alias("pointer"), F.try_element_at("members", p["name"]).alias("node"))))).filter("node is not null")


def openapi_operations(docs: DataFrame) -> DataFrame:
    """(path, operation, method, route, name, node) of every operation."""
    routes = docs.select("path", F.inline(_members(json_value("doc", "$.paths", "variant")))).select(
        "path", F.col("key").alias("route"), F.col("value").alias("_item"))
    ops = routes.select("path", "route", F.inline(_members(F.col("_item")))).filter(
        F.lower("key").isin(*METHODS) & _is_object(F.col("value")))
    return ops.select(
        "path", F.concat(F.lit("openapi:"), F.upper("key"), F.lit(":"), "route").alias("operation"),
        F.col("key").alias("method"), "route",
        F.coalesce(F.nullif(json_value("value", "$.summary"), F.lit("")),
                   F.nullif(json_value("value", "$.operationId"), F.lit("")), "route").alias("name"),
        F.col("value").alias("node"))


def openapi_parameters(docs: DataFrame) -> DataFrame:
    """(path, operation, role, ordinal, definition): request parameters and bodies.

    Parameters of the route come before those of the operation itself; ordinals
    start at 0 within a role.
    """
    routes = docs.select("path", F.inline(_members(json_value("doc", "$.paths", "variant")))).select(
        "path", F.concat(F.lit("openapi:"), F.lit("{}:"), "key").alias("_form"), F.col("value").alias("_item"))
    ops = routes.select("path", "_form", "_item", F.inline(_members(F.col("_item")))).filter(
        F.lower("key").isin(*METHODS) & _is_object(F.col("value")))
    nothing = F.array().cast("array<variant>")
    given = F.concat(F.coalesce(json_value("_item", "$.parameters", "array<variant>"), nothing),
                     F.coalesce(json_value("value", "$.parameters", "array<variant>"), nothing))
    body = F.array_compact(F.array(json_value("value", "$.requestBody", "variant")))
    named = ops.select("path", F.replace("_form", F.lit("{}:"), F.concat(F.upper("key"), F.lit(":"))).alias("operation"),
                       given.alias("request_parameter"), body.alias("request_body"))
    roles = ("request_parameter", "request_body")
    return _union([named.select("path", "operation", F.lit(r).alias("role"), F.posexplode(r).alias("ordinal", "definition"))
                   for r in roles])


def _follow_responses(resp: DataFrame, refs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Responses with every reference to a further response resolved, and the issues met.

    One round follows one reference of each; a reference met before ends its chain.
    """
    open_ones = resp.withColumn("_met", F.array().cast("array<string>"))
    ready, issues = [], []
    while True:
        pointed = open_ones.withColumn("_ref", F.nullif(json_value("node", "$['$ref']"), F.lit("")))
        ready.append(pointed.filter("_ref is null").select(*resp.columns))
        step = pointed.filter("_ref is not null")
        if not step.limit(1).count():
            return _union(ready), issues
        step = materialize(step.join(refs, ["path", "_ref"], "left"), "responses")
        again = F.array_contains("_met", F.col("_ref"))
        reason = (F.when(again, F.lit("recursive_response_reference"))
                  .when(~F.col("_ref").startswith("#/"), F.lit("external_schema_reference_not_fetched"))
                  .when(F.col("_target").isNull(), F.concat(F.lit("local_schema_reference_missing:"), "_ref")))
        step = step.withColumn("reason", reason)
        issues.append(step.filter("reason is not null").select("path", "operation", "locator", "reason"))
        open_ones = step.filter("reason is null").select(
            "path", "operation", "status", F.col("_target").alias("node"), F.col("_ref").alias("locator"),
            F.array_append("_met", F.col("_ref")).alias("_met"))


def response_roots(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, list[DataFrame]]:
    """(nodes by pointer, operations, root schemas of the responses, issues of lost responses)."""
    refs = materialize(document_nodes(docs), "refs").select(
        "path", F.col("pointer").alias("_ref"), F.col("node").alias("_target"))
    ops = materialize(openapi_operations(docs), "operations")
    resp = ops.select("path", "operation", "method", "route",
                      F.inline(_members(json_value("node", "$.responses", "variant")))).select(
        "path", "operation", F.col("key").alias("status"), F.col("value").alias("node"),
        F.concat(F.lit("#/paths/"), _escape(F.col("route")), F.lit("/"), "method", F.lit("/responses/"), "key").alias("locator"))
    resp, lost = _follow_responses(resp, refs)
    direct = resp.select("path", "operation", "status", F.lit(None).cast("string").alias("media"),
                         json_value("node", "$.schema", "variant").alias("schema"),
                         F.concat("locator", F.lit("/schema")).alias("locator"))
    typed = resp.select("path", "operation", "status", "locator",
                        F.inline(_members(json_value("node", "$.content", "variant")))).select(
        "path", "operation", "status", F.col("key").alias("media"),
        json_value("value", "$.schema", "variant").alias("schema"),
        F.concat("locator", F.lit("/content/"), _escape(F.col("key")), F.lit("/schema")).alias("locator"))
    roots = direct.unionByName(typed).filter(_is_object(F.col("schema")))
    return refs, ops, roots, lost


def openapi_fields(docs: DataFrame, max_depth: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fields, issues, operations) of the response schemas of OpenAPI documents.

    Schemas unfold level by level: all open schema nodes of all documents take
    one step per round, references by an equality join with ``document_nodes``.
    A reference already on a node's own chain is a recursion issue, which ends
    every chain; dynamic properties, unresolved references and, only when it is
    given, nodes deeper than ``max_depth`` are issues too.
    """
    refs, ops, roots, lost = response_roots(docs)
    strings = F.array().cast("array<string>")
    open_nodes = materialize(roots.select(
        "path", "operation", "status", "media", "schema", "locator", strings.alias("names"), strings.alias("chain"),
        F.lit("").alias("variant")), "openapi")
    per_op = open_nodes.groupBy("path", "operation").agg(F.count(F.lit(1)).alias("response_schemas_observed"))
    fields, issues, depth = [], lost, 0
    while (max_depth is None or depth <= max_depth) and open_nodes.limit(1).count():
        depth += 1
        step = materialize(schema_step(open_nodes, refs), "openapi")
        fields.append(step.filter("outcome = 'field'"))
        issues.append(step.filter("outcome = 'issue'").select("path", "operation", "locator", "reason"))
        open_nodes = step.filter("outcome = 'open'").select(*open_nodes.columns)
    issues.append(open_nodes.select("path", "operation", "locator", F.lit("schema_expansion_limit").alias("reason")))
    all_fields = _union(fields) if fields else None
    out = None
    if all_fields is not None:
        named = F.filter("names", lambda n: n != "[]")
        last = F.element_at(named, -1)
        out = all_fields.select(
            "path", "operation", "status", "media", F.coalesce(F.nullif(json_value("schema", "$.title"), F.lit("")), last).alias("name"),
            F.when(last.rlike("^[\\x00-\\x7f]*$"), last).alias("name_en"),
            json_value("schema", "$.description").alias("description"), json_value("schema", "$.type").alias("datatype"),
            F.array_join("names", ".").alias("schema_path"), F.nullif("variant", F.lit("")).alias("schema_variant"), "locator")
    all_issues = _union(issues)
    counts = (out.groupBy("path", "operation").agg(F.count(F.lit(1)).alias("output_fields")) if out is not None
              else per_op.select("path", "operation", F.lit(0).cast("long").alias("output_fields")))
    problems = all_issues.groupBy("path", "operation").agg(F.count(F.lit(1)).alias("unresolved_schema_parts"))
    summary = (ops.select("path", "operation", F.upper("method").alias("method"), "route", "name")
               .join(per_op, ["path", "operation"], "left").join(counts, ["path", "operation"], "left")
               .join(problems, ["path", "operation"], "left")
               .na.fill(0, ["response_schemas_observed", "output_fields", "unresolved_schema_parts"]))
    summary = summary.withColumn("status", F.when(F.col("output_fields") > 0, F.lit("definition_observed"))
                                 .otherwise(F.lit("definition_unresolved")))
    return out, all_issues, summary


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


COMPOSITES = ("allOf", "oneOf", "anyOf")


def schema_parts(s: Column) -> list[Column]:
    """What the rules look at in the schema ``s``, as columns: each part is taken out of the schema once."""
    return [_is_object(s).alias("_object"), _members(json_value(s, "$.properties", "variant")).alias("_props"),
            json_value(s, "$.items", "variant").alias("_items"), json_value(s, "$.additionalProperties", "variant").alias("_extra"),
            json_value(s, "$.type").alias("_type"), *[json_value(s, f"$.{word}", "array<variant>").alias(f"_{word}") for word in COMPOSITES]]


def has_dynamic_properties() -> Column:
    empty = F.to_json("_extra").isin("null", "false", "0", '""', "[]", "{}")
    return F.col("_extra").isNotNull() & ~F.coalesce(empty, F.lit(False))


def has_item_fields() -> Column:
    """An array whose items have a shape of their own."""
    items = F.col("_items")
    deep = (F.col("_type") == "array") & _is_object(items) & (
        json_value(items, "$['$ref']").isNotNull() | (F.size(_members(json_value(items, "$.properties", "variant"))) > 0)
        | (json_value(items, "$.type") == "array") | json_value(items, "$.allOf", "variant").isNotNull()
        | json_value(items, "$.oneOf", "variant").isNotNull() | json_value(items, "$.anyOf", "variant").isNotNull())
    return F.coalesce(deep, F.lit(False))


def schema_step(nodes: DataFrame, refs: DataFrame) -> DataFrame:
    """One unfolding step of every open schema node; outcome is open, field, issue or nameless.

    A nameless leaf has array steps only; it is neither a field nor an issue, but is a field where its user names it.
    """
    s = F.col("schema")
    ref = json_value(s, "$['$ref']")
    n = nodes.withColumn("_ref", ref).join(refs, ["path", "_ref"], "left")
    here = n.select("*", F.when(F.col("_ref").isNotNull(), F.lit("ref")).otherwise(F.lit("node")).alias("_kind"), *schema_parts(s))

    def row(outcome: str, schema: Column, locator: Column, names: Column, chain: Column, variant: Column,
            reason: Column | None = None) -> Column:
        return F.struct(F.lit(outcome).alias("outcome"), schema.alias("schema"), locator.alias("locator"),
                        names.alias("names"), chain.alias("chain"), variant.alias("variant"),
                        (reason if reason is not None else F.lit(None).cast("string")).alias("reason"))

    loc, names, chain, var = (F.col(c) for c in ("locator", "names", "chain", "variant"))

    def issue(reason: Column) -> Column:
        return row("issue", s, loc, names, chain, var, reason)

    none = F.slice(F.array(issue(F.lit(""))), 1, 0)
    by_ref = F.when(F.array_contains(chain, F.col("_ref")), F.array(issue(F.lit("recursive_schema_reference")))).when(
        F.col("_target").isNull(), F.array(issue(F.when(
            F.col("_ref").startswith("#/"), F.concat(F.lit("local_schema_reference_missing:"), F.col("_ref")))
            .otherwise(F.lit("external_schema_reference_not_fetched"))))).otherwise(
        F.array(row("open", F.col("_target"), F.col("_ref"), names, F.array_append(chain, F.col("_ref")), var)))

    def part_of(word: str):
        return lambda p, i: row("open", p, F.concat(loc, F.lit(f"/{word}/"), i.cast("string")), names, chain,
                                F.concat(var, F.lit(f"/{word}/"), i.cast("string")))

    composite = none
    has_composite = F.lit(False)
    for word in COMPOSITES:
        parts = F.col(f"_{word}")
        has_composite = has_composite | parts.isNotNull()
        composite = F.concat(composite, F.coalesce(F.transform(parts, part_of(word)), none))
    props, dynamic = F.col("_props"), has_dynamic_properties()
    by_props = F.concat(
        F.when(dynamic, F.array(issue(F.lit("additional_dynamic_properties_not_enumerated")))).otherwise(none),
        F.transform(props, lambda m: row(
            "open", m["value"], F.concat(loc, F.lit("/properties/"), _escape(m["key"])),
            F.array_append(names, m["key"]), chain, var)))
    by_items = F.array(row("open", F.col("_items"), F.concat(loc, F.lit("/items")), F.array_append(names, F.lit("[]")), chain, var))
    bare = F.coalesce(F.col("_type") == "object", F.lit(False)) | dynamic
    named = F.size(F.filter(names, lambda x: x != "[]")) > 0
    leaf = (F.when(has_composite, none).when(bare, F.array(issue(F.lit("object_without_fixed_properties"))))
            .when(F.size(names) == 0, F.array(issue(F.lit("scalar_response_without_named_field"))))
            .when(named, F.array(row("field", s, loc, names, chain, var)))
            .otherwise(F.array(row("nameless", s, loc, names, chain, var))))
    by_node = F.when(~F.col("_object"), F.array(issue(F.lit("schema_not_object")))).otherwise(F.concat(
        composite, F.when(F.size(props) > 0, by_props).when(has_item_fields(), by_items).otherwise(leaf)))
    return here.select("path", "operation", "status", "media", F.inline(
        F.when(F.col("_kind") == "ref", by_ref).otherwise(by_node)))
