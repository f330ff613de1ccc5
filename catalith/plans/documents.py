"""Queries that read column definitions out of documents.

The given tables hold no specification documents, so each query lets Spark write
one document per table row and reads it back; the SQL states the row directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.functions import html as ht
from catalith.functions import metadata as md
from catalith.functions import text as tx
from catalith.operators import coverage as cv
from catalith.operators import schema_docs as sd
from catalith.operators import shared_schemas as ss
from catalith.plans.registry import Tables, query
from catalith.plans.web import _clean, _decode
from catalith.sources import definitions as df_
from catalith.sources.definitions import documents_from_text, json_value


def _words(t: Tables):
    return t.spread("part").withColumn("w0", F.split("p_name", " ")[0]).withColumn("w1", F.split("p_name", " ")[1])


_PART = "part AS (SELECT *, split_part(p_name, ' ', 1) AS w0, split_part(p_name, ' ', 2) AS w1 FROM main.part)"


def _cat(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


def _table_html(t: Tables):
    c = F.col
    return _words(t).select("p_partkey", _cat(
        "<html><table class=x><caption>spec</caption><thead><tr><th>영문</th><th>국문</th><th>설명</th></tr></thead><tbody><tr><td>",
        c("w0"), "</td><td>", c("w1"), "</td><td>", c("p_type"), "</td></tr><tr><td>", c("p_brand"), "</td><td>", c("p_name"),
        "</td></tr></tbody></table><table><caption>codes</caption><tbody><tr><td rowspan=\"2\">", c("p_brand"),
        "</td><td>", c("w0"), "</td></tr><tr><td>", c("w1"), "</td></tr></tbody></table><table><caption>용어해설</caption>",
        "<tr><td>", c("w1"), "</td><td>", c("p_type"), " &amp; more</td></tr></table></html>").alias("html"))


def _cells(t: Tables):
    return ht.table_cells(_table_html(t), ["p_partkey"], "html")


@query("q67_table_fields", f"""WITH {_PART} SELECT p_partkey, 'table[0].tbody.tr[0]' AS locator, w0 AS name_en, w1 AS name, p_type AS description FROM part""")
def table_fields(t: Tables):
    f, _ = sd.table_fields(_cells(t), ["p_partkey"], {"name_en": "영문", "name": "국문", "description": "설명"}, "spec")
    return f.select("p_partkey", "locator", "name_en", "name", "description")


@query("q87_table_issues", """SELECT p_partkey, 1 AS row_no, 'unexpected_row_width' AS issue, 2 AS cells FROM part""")
def table_issues(t: Tables):
    _, i = sd.table_fields(_cells(t), ["p_partkey"], {"name_en": "영문", "name": "국문", "description": "설명"}, "spec")
    return i.select("p_partkey", F.col("row_no").cast("int").alias("row_no"), "issue", F.col("cells").cast("int").alias("cells"))


@query("q68_rowspan", f"""WITH {_PART} SELECT p_partkey, 0 AS row_no, 0 AS col, p_brand AS text FROM part UNION ALL SELECT p_partkey, 0, 1, w0 FROM part
  UNION ALL SELECT p_partkey, 1, 0, p_brand FROM part UNION ALL SELECT p_partkey, 1, 1, w1 FROM part""")
def rowspan(t: Tables):
    logical, _ = sd.expand_rowspan(_cells(t).filter("caption = 'codes'"), ["p_partkey"])
    return logical.select("p_partkey", "row_no", "col", "text")


@query("q77_glossary", f"""WITH {_PART} SELECT p_partkey, w1 AS term, p_type || ' & more' AS definition, 'table[2].tr[0]' AS locator FROM part""")
def glossary(t: Tables):
    return sd.glossary_terms(_cells(t), ["p_partkey"], "용어해설").drop("mapping_status")


@query("q69_select_options", f"""WITH {_PART} SELECT p_partkey, 'sel' AS "select", CAST(p_size AS VARCHAR) AS value, w0 AS text FROM part
  UNION ALL SELECT p_partkey, 'sel', '', w1 FROM part""")
def select_options(t: Tables):
    h = _words(t).select("p_partkey", _cat('<select name="sel"><option value="', F.col("p_size").cast("string"), '">',
                                           F.col("w0"), "<option>", F.col("w1"), "</option></select>").alias("html"))
    return h.select("p_partkey", F.inline(ht.select_options("html")))


@query("q70_declared_list", f"""WITH {_PART} SELECT p_partkey, CASE WHEN p_size > 25 THEN w0 || ', ' || w1 || '|' || p_type
  ELSE '`' || w0 || '|' || w1 || '|' || p_type END AS names FROM part""")
def declared_list(t: Tables):
    quoted = _cat("`", F.col("w0"), ", ", F.col("w1"), "` , `", F.col("p_type"), "`")
    plain = _cat("`", F.col("w0"), ", ", F.col("w1"), ", ,", F.col("p_type"))
    c = F.when(F.col("p_size") > 25, quoted).otherwise(plain)
    return _words(t).select("p_partkey", F.array_join(tx.declared_list(c), "|").alias("names"))


@query("q71_csv_cell", f"""WITH {_PART} SELECT p_partkey, CASE WHEN p_size > 25 THEN w0 || ', "' || w1 || '"|' || p_type || '|' ELSE '' END AS cells FROM part""")
def csv_cell(t: Tables):
    good = _cat('"', F.col("w0"), ', ""', F.col("w1"), '""", ', F.col("p_type"), ",")
    c = F.when(F.col("p_size") > 25, good).otherwise(_cat('"', F.col("w0"), '" x,', F.col("w1")))
    return _words(t).select("p_partkey", F.array_join(tx.csv_cell(c), "|").alias("cells"))


def _stat_docs(t: Tables):
    def s(**kw):
        return F.struct(*[v.alias(k) for k, v in kw.items()])

    key = F.col("c_custkey").cast("string")
    doc = s(orgId=F.col("c_nationkey").cast("string"), tblId=key,
            classInfoList=F.array(s(classNm=F.col("c_mktsegment"), classEngNm=F.lit("seg"), classId=F.lit("A"), itmCnt=F.lit(2),
                                    itmList=F.when(F.col("c_acctbal") > 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))),
            itemInfo=s(itmCnt=F.lit(1), itmList=F.array(s(scrKor=F.col("c_name"), itmId=F.lit("m1"), unitNm=F.lit("원")))),
            periodStr=F.lit("M#Q#"), periodInfo=s(periodNm=F.lit("기간"), codeM=F.lit("M"), nameM=F.lit("월"), startM=key, endM=key))
    return documents_from_text(t.spread("customer").select(key.alias("p"), F.to_json(doc).alias("j")), "p", "j")


@query("q72_stat_table_fields", """SELECT CAST(c_custkey AS VARCHAR) AS path, u.role AS role, u.name AS name, u.code AS code, u.unit AS unit, u.ok AS complete
  FROM (SELECT c_custkey, unnest([{'role': 'statistical_dimension', 'name': c_mktsegment, 'code': 'A', 'unit': NULL, 'ok': c_acctbal > 0},
    {'role': 'statistical_measure', 'name': c_name, 'code': 'm1', 'unit': '원', 'ok': NULL},
    {'role': 'statistical_period', 'name': '기간', 'code': 'period', 'unit': NULL, 'ok': NULL}]) AS u FROM customer)""")
def stat_table_fields(t: Tables):
    f, _ = sd.stat_table_fields(_stat_docs(t), [("$.tblId", F.col("path"))])
    return f.select("path", "role", "name", "code", "unit", F.col("code_list_complete").alias("complete"))


@query("q88_stat_identity", """SELECT CAST(c_custkey AS VARCHAR) AS path, c_nationkey = 3 AS identity_ok, true AS measure_list_complete FROM customer""")
def stat_identity(t: Tables):
    _, d = sd.stat_table_fields(_stat_docs(t), [("$.orgId", F.lit("3"))])
    return d.select("path", "identity_ok", "measure_list_complete")


@query("q89_dimension_coverage", """SELECT count(*) AS tables, CAST(sum(2) AS BIGINT) AS declared_codes,
  CAST(sum(CASE WHEN c_acctbal > 0 THEN 2 ELSE 1 END) AS BIGINT) AS observed_codes, count(*) FILTER (c_acctbal > 0) AS reconciled FROM customer""")
def dimension_coverage(t: Tables):
    f, _ = sd.stat_table_fields(_stat_docs(t))
    return sd.dimension_coverage(f).agg(
        F.count(F.lit(1)).alias("tables"), F.sum("declared_codes").alias("declared_codes"),
        F.sum("observed_codes").alias("observed_codes"), F.count_if("all_reconcile").alias("reconciled"))


@query("q90_stat_periods", """SELECT CAST(c_custkey AS VARCHAR) AS path, 'M' AS code, '월' AS name, CAST(c_custkey AS VARCHAR) AS start FROM customer""")
def stat_periods(t: Tables):
    return sd.stat_periods(_stat_docs(t)).select("path", "code", "name", "start")


def _api_docs(t: Tables):
    key = F.col("s_suppkey").cast("string")
    doc = _cat('{"openapi":"3.0","paths":{"/s/', key, '":{"get":{"summary":"', F.col("s_name"), '","responses":{"200":{"content":',
               '{"application/json":{"schema":{"$ref":"#/components/schemas/Root"}}}}}}}},"components":{"schemas":{"Root":',
               '{"properties":{"n', key, '":{"type":"integer"},"rows":{"type":"array","items":{"$ref":"#/components/schemas/Row"}}}},',
               '"Row":{"properties":{"id":{"type":"string"},"up":{"$ref":"#/components/schemas/Root"}}}}}}')
    return documents_from_text(t.spread("supplier").select(key.alias("p"), doc.alias("j")), "p", "j")


@query("q50_openapi_fields", """SELECT CAST(s_suppkey AS VARCHAR) AS path, 'openapi:GET:/s/' || s_suppkey AS operation, 'n' || s_suppkey AS schema_path,
    'integer' AS datatype FROM supplier
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'openapi:GET:/s/' || s_suppkey, 'rows.[].id', 'string' FROM supplier""")
def openapi_fields(t: Tables):
    f, _, _ = sd.openapi_fields(_api_docs(t))
    return f.select("path", "operation", "schema_path", "datatype")


@query("q91_openapi_operations", """SELECT CAST(s_suppkey AS VARCHAR) AS path, s_name AS name, CAST(2 AS BIGINT) AS output_fields,
  CAST(1 AS BIGINT) AS unresolved_schema_parts, 'definition_observed' AS status FROM supplier""")
def openapi_operations(t: Tables):
    _, _, o = sd.openapi_fields(_api_docs(t))
    return o.select("path", "name", "output_fields", "unresolved_schema_parts", "status")


def _varied_api_docs(t: Tables):
    """Schemas that each use the next one twice, at a depth given by the row; some lack a part, some are recursive."""
    key, depth = F.col("p_partkey").cast("string"), (F.col("p_partkey") % 21).cast("int")
    below = F.concat(F.lit('{"$ref":"#/components/schemas/S'), F.lit("{}"), F.lit('"}'))
    links = F.array_join(F.transform(F.sequence(F.lit(0), depth), lambda k: F.concat(
        F.lit('"S'), k.cast("string"), F.lit('":{"properties":{"l":'), F.replace(below, F.lit("{}"), (k + 1).cast("string")),
        F.lit(',"r":'), F.replace(below, F.lit("{}"), (k + 1).cast("string")), F.lit("}},"))), "")
    last = F.concat(F.lit('"S'), (depth + 1).cast("string"), F.lit('":{"properties":{"x":{"type":"string"},"y":{"type":"integer"}'),
                    F.when(F.col("p_partkey") % 7 == 3, F.lit(',"m":{"$ref":"#/components/schemas/None"}')).otherwise(F.lit("")),
                    F.when(depth == 1, F.lit(',"up":{"$ref":"#/components/schemas/S0"}')).otherwise(F.lit("")), F.lit("}}"))
    given = F.array_join(F.transform(F.sequence(F.lit(0), F.col("p_size") % 3), lambda k: F.concat(F.lit('{"name":"a'), k.cast("string"), F.lit('"}'))), ",")
    body = F.when(F.col("p_size") % 2 == 0, F.lit('"requestBody":{"required":true},')).otherwise(F.lit(""))
    doc = F.concat(F.lit('{"openapi":"3.0","paths":{"/p/'), key, F.lit('":{"parameters":[{"name":"route"}],"post":{"operationId":"'), F.col("p_name"),
                   F.lit('","parameters":['), given, F.lit("],"), body, F.lit('"responses":{"200":{"schema":{"$ref":"#/components/schemas/S0"}}}}}},"components":{"schemas":{'),
                   links, last, F.lit("}}}"))
    return documents_from_text(t.spread("part").select(key.alias("p"), doc.alias("j")), "p", "j", keep_text=True)


@query("q188_openapi_counts", """SELECT CAST(p_partkey AS VARCHAR) AS path, 'openapi:POST:/p/' || p_partkey AS operation, p_name AS name,
  CAST(2 ** (p_partkey % 21 + 2) AS BIGINT) AS output_fields,
  CAST(2 ** (p_partkey % 21 + 1) * (CASE WHEN p_partkey % 7 = 3 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 21 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS unresolved_schema_parts FROM part""")
def openapi_counts(t: Tables):
    return ss.openapi_counts(_varied_api_docs(t)).select("path", "operation", "name", F.col("output_fields").cast("long").alias("output_fields"),
                                                         F.col("unresolved_schema_parts").cast("long").alias("unresolved_schema_parts"))


@query("q189_openapi_parameters", """SELECT CAST(p_partkey AS VARCHAR) AS path, 'openapi:POST:/p/' || p_partkey AS operation, 'request_parameter' AS role,
    CAST(u.k AS INTEGER) AS ordinal, CASE WHEN u.k = 0 THEN '{"name":"route"}' ELSE '{"name":"a' || (u.k - 1) || '"}' END AS definition
  FROM part, unnest(range(p_size % 3 + 2)) AS u(k)
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'openapi:POST:/p/' || p_partkey, 'request_body', 0, '{"required":true}' FROM part WHERE p_size % 2 = 0""")
def openapi_parameters(t: Tables):
    return sd.openapi_parameters(_varied_api_docs(t)).withColumn("definition", F.to_json("definition"))


@query("q74_preview_headers", f"""WITH {_PART} SELECT CAST(p_partkey AS VARCHAR) AS path, w0 AS value, 'listHead[0][0]' AS locator FROM part WHERE p_size > 10
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), w1, 'listHead[0][1]' FROM part WHERE p_size > 10""")
def preview_headers(t: Tables):
    h, _ = sd.preview_headers(_previews(t))
    return h.select("path", "value", "locator")


def _previews(t: Tables):
    full = _cat('{"numberOfCells":2,"listHead":[["', F.col("w0"), '","', F.col("w1"), '"]],"listRow":[]}')
    text = F.when(F.col("p_size") > 10, full).when(F.col("p_size") > 5, F.lit('{"numberOfCells":0,"listHead":null,"listRow":null}')).otherwise(
        F.lit('{"numberOfCells":"x"}'))
    return documents_from_text(_words(t).select(F.col("p_partkey").cast("string").alias("p"), text.alias("j")), "p", "j")


@query("q92_preview_status", """SELECT CASE WHEN p_size > 10 THEN 'preview_header_candidates_observed' WHEN p_size > 5 THEN 'preview_header_empty'
  ELSE 'preview_parse_unresolved' END AS status, count(*) AS n FROM part GROUP BY 1""")
def preview_status(t: Tables):
    return cv.status_histogram(sd.preview_headers(_previews(t))[1], "status")


@query("q75_axis_items", """SELECT CAST(o_orderkey AS VARCHAR) AS path, o_orderstatus AS code, o_orderpriority AS name, 'statistical_row_item' AS role FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'COL', 'col', 'statistical_column_item' FROM orders""")
def axis_items(t: Tables):
    doc = _cat('{"dataset":[{"id":"ds_rowItem","rows":[{"ROW_CD":"', F.col("o_orderstatus"), '","ROW_NM":"', F.col("o_orderpriority"),
               '"},{"ROW_CD":"","ROW_NM":"x"}]},{"id":"ds_colItem","rows":[{"DB_COL_NM":"COL","COL_NM":"col"}]}]}')
    docs = documents_from_text(t.spread("orders").select(F.col("o_orderkey").cast("string").alias("p"), doc.alias("j")), "p", "j")
    return sd.axis_items(docs)[0].select("path", "code", "name", "role")


@query("q76_unpivot_pairs", f"""WITH {_PART} SELECT p_partkey, 0 AS cell_start, w0 AS name_en, w1 AS name FROM part
  UNION ALL SELECT p_partkey, 2, p_type, p_type FROM part WHERE p_size > 25""")
def unpivot_pairs(t: Tables):
    cells = F.array(F.col("w0"), F.col("w1"), F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.lit("")), F.lit(""))
    f, _ = sd.unpivot_pairs(_words(t).select("p_partkey", cells.alias("cells")), ["p_partkey"], "cells")
    return f.select("p_partkey", "cell_start", "name_en", "name")


def _definition_docs(t: Tables):
    f = _cat('{"portal_id":"', F.col("p_brand"), '","dataset_key":"', F.col("p_partkey").cast("string"), '","evidence_id":"ev","source_url":"u","fields":[{"name":"',
             F.col("w0"), '","unit":"-","description":""},{"name":"', F.col("w1"), '","name_en":"', F.col("p_type"), '","evidence_id":"own"}]}')
    return documents_from_text(_words(t).select(F.col("p_partkey").cast("string").alias("p"), f.alias("j")), "p", "j")


@query("q93_definition_fields", f"""WITH {_PART} SELECT CAST(p_partkey AS VARCHAR) AS path, CAST(1 AS INTEGER) AS ordinal, w0 AS name, NULL AS name_en, NULL AS unit, NULL AS description, 'ev' AS evidence_id FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 2, w1, p_type, NULL, NULL, 'own' FROM part""")
def definition_fields(t: Tables):
    return df_.definition_fields(_definition_docs(t)).select("path", "ordinal", "name", "name_en", "unit", "description", "evidence_id")


@query("q94_attach_definitions", """SELECT CAST(sum(CASE WHEN p_size > 25 THEN 2 ELSE 0 END) AS BIGINT) AS attached,
  count(*) FILTER (p_size <= 25) AS unmatched FROM part""")
def attach_definitions(t: Tables):
    fields = df_.definition_fields(_definition_docs(t))
    rec = t.part.filter("p_size > 25").select(F.concat(F.lit("r"), F.col("p_partkey").cast("string")).alias("id"),
                                              F.col("p_brand").alias("portal_id"), F.col("p_partkey").cast("string").alias("dataset_key"),
                                              F.col("p_type").alias("kind"))
    a = df_.attach_definitions(fields, rec).select(F.lit(1).alias("hit"))
    u = df_.unmatched_documents(fields, rec).select(F.lit(0).alias("hit"))
    return a.unionAll(u).agg(F.count_if(F.col("hit") == 1).alias("attached"), F.count_if(F.col("hit") == 0).alias("unmatched"))


@query("q78_json_path", """SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n, CAST(count(*) AS BIGINT) AS members FROM events GROUP BY 1""")
def json_path(t: Tables):
    doc = F.try_parse_json("props")
    e = t.events.select(json_value(doc, "$.k", "int").alias("k"),
                        df_.json_array_length(F.parse_json(F.concat(F.lit("["), "props", F.lit("]"))), "$").alias("len"))
    return e.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("members"))


@query("q79_text_functions", """SELECT p_partkey, p_brand AS provider, CAST(p_size AS VARCHAR) AS unit, CASE WHEN p_type IN ('SMALL', 'PROMO') THEN p_type END AS datatype,
  lower(p_name) AS folded, CASE WHEN p_size > 25 THEN p_brand || '/' || p_partkey ELSE 'unresolved-' || substr(sha256(p_brand || chr(31) || p_name), 1, 20) END AS key,
  CASE WHEN p_size > 25 THEN 'API,LINK' ELSE 'API' END AS tags FROM part""")
def text_functions(t: Tables):
    size = F.col("p_size").cast("string")
    return t.part.select(
        "p_partkey", tx.provider_prefix(_cat(F.col("p_brand"), " ,「", F.col("p_name"))).alias("provider"),
        tx.literal_unit(_cat(F.col("p_name"), " (단위 : ", size, ")")).alias("unit"),
        tx.declared_datatype("p_type", ("SMALL", "PROMO")).alias("datatype"), tx.ascii_fold(F.upper("p_name")).alias("folded"),
        tx.identity_key(F.col("p_size") > 25, [F.col("p_brand"), F.col("p_partkey").cast("string")],
                        [F.col("p_brand"), F.col("p_name")]).alias("key"),
        F.array_join(tx.shape_tags(API=F.col("p_name"), FILE=F.lit(None), LINK=F.when(F.col("p_size") > 25, size)), ",").alias("tags"))


@query("q95_clean_text", f"""SELECT doc_id, sha256({_clean("text")}) AS digest FROM documents""")
def clean_text(t: Tables):
    return t.spread("documents").select("doc_id", F.sha2(tx.clean_text("text"), 256).alias("digest"))


@query("q80_metadata_flags", """SELECT doc_id, concat_ws(',', CASE WHEN n_chars < 500 THEN 'missing_description' END, 'missing_keywords',
  CASE WHEN contains(source || ' ' || (CASE WHEN n_chars >= 500 THEN text ELSE '' END), '�') THEN 'broken_encoding' END, CASE WHEN n_chars < 500 THEN 'insufficient_metadata' END) AS flags FROM documents""")
def metadata_flags(t: Tables):
    d = t.documents
    f = tx.metadata_flags(F.col("source"), F.when(F.col("n_chars") >= 500, F.col("text")), F.lit(None).cast("string"), F.col("lang"))
    return d.select("doc_id", F.array_join(f, ",").alias("flags"))


_TAGLESS = _decode("regexp_replace(nfc_normalize(text), '(?s)<[!/?a-zA-Z][^>]*>', ' ', 'g')")


@query("q81_normalize_metadata", f"""SELECT conv_id, turn, {_clean(f"regexp_replace({_TAGLESS}, '[[:cntrl:]]', ' ', 'g')")} AS title_norm,
  role || '|x' AS keywords FROM conversations""")
def normalize_metadata(t: Tables):
    c = t.spread("conversations")
    c = c.withColumn("kw", _cat(F.col("role"), " , ,x"))
    n = md.normalize_metadata(c, "text", "role", "kw")
    return n.select("conv_id", "turn", "title_norm", F.array_join("keyword_list", "|").alias("keywords"))


@query("q96_local_time", """SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS label FROM events""")
def local_time(t: Tables):
    return t.events.select("event_id", tx.local_time_label("ts").alias("label"))


@query("q51_net_rate", """SELECT user_id, round((count(*) FILTER (event_type = 'error') - count(*) FILTER (event_type = 'signup'))
  * 1000.0 / nullif(count(*) FILTER (event_type = 'purchase'), 0), 6) AS rate FROM events GROUP BY 1""")
def net_rate(t: Tables):
    e = F.col("event_type")
    g = t.events.groupBy("user_id").agg(F.count_if(e == "error").alias("o"), F.count_if(e == "signup").alias("i"), F.count_if(e == "purchase").alias("p"))
    return g.select("user_id", F.round(tx.net_rate(F.col("o"), F.col("i"), F.col("p")), 6).alias("rate"))


@query("q97_private_fields", """SELECT c_custkey, c_mktsegment AS kept FROM customer""")
def private_fields(t: Tables):
    m = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("staff_phone"), F.col("c_name"))
    out = tx.drop_private_fields(m, ("staff_phone", "uploader"))
    return t.customer.select("c_custkey", F.array_join(F.map_values(out), ",").alias("kept"))
