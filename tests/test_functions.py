import pytest
from pyspark.sql import functions as F

from catalith.functions import html as H
from catalith.functions import text as T
from catalith.functions import url as U


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect()[0]


def test_uid_hashes_missing_parts_as_text(spark):
    from hashlib import sha256
    want = "p-" + sha256("a\x1fNone".encode()).hexdigest()[:20]
    got = one(spark, T.uid("p", F.lit("a"), F.lit(None)), T.uid("p", F.lit("a")))
    assert got[0] == want and got[1] != want


def test_fingerprint_is_key_ordered_and_keeps_nulls(spark):
    from hashlib import sha256
    got = one(spark, T.fingerprint(b=F.lit(None).cast("string"), a=F.lit("x")))
    assert got[0] == sha256(b'{"a":"x","b":null}').hexdigest()


def test_text(spark):
    got = one(spark, T.clean_text(F.lit(" a \n b\x1c ")), T.ascii_fold(F.lit("ÀBC")), T.blank_to_null(F.lit("-")),
              T.blank_to_null(F.lit("0")), T.provider_prefix(F.lit("통계청,「조사」")), T.provider_prefix(F.lit(" ,「x")),
              T.literal_unit(F.lit("값(단위 : 명)")), T.literal_unit(F.lit("값")),
              T.net_rate(F.lit(5), F.lit(2), F.lit(0)), T.net_rate(F.lit(5), F.lit(2), F.lit(1000)))
    assert list(got) == ["a b", "Àbc", None, "0", "통계청", None, "명", None, None, 3.0]


@pytest.mark.parametrize("value,want", [
    ("`a,b` , `c`", ["a,b", "c"]), ("`a`, b", ["`a`", "b"]), (" x , ,y", ["x", "y"]), ("", []), (None, [])])
def test_declared_list(spark, value, want):
    assert one(spark, T.declared_list(F.lit(value).cast("string")))[0] == want


@pytest.mark.parametrize("value,want", [
    ('a, "b,""c""",', ["a", 'b,"c"', ""]), ('"a" x', []), ("a\nb", []), ("", []), ("한글,값", ["한글", "값"])])
def test_csv_cell(spark, value, want):
    assert one(spark, T.csv_cell(F.lit(value)))[0] == want


def test_category_path(spark):
    got = one(spark, T.category_path_terms(F.lit("root > a >  b > T "), F.lit("T")),
              T.category_path_terms(F.lit("root > a > b"), F.lit("T")))
    assert [t.label for t in got[0]] == ["a", "b"] and [t.locator for t in got[1]] == ["segment[1]", "segment[2]"]


def test_literal_and_pattern_search(spark):
    df = spark.createDataFrame([("50%_A",), ("50xyA",), ("' or 1=1 --",), (None,)], "s string")
    hit = lambda c: [r.s for r in df.filter(c).collect()]
    assert hit(T.contains_literal("s", "%_")) == ["50%_A"]
    assert hit(T.contains_literal("s", "' OR 1=1 --")) == ["' or 1=1 --"]
    assert hit(T.contains_pattern("s", "0__a")) == ["50%_A", "50xyA"]


@pytest.mark.parametrize("url,want", [
    ("https://WWW.A.kr:80/x", "a.kr"), ("//b.kr/y", "b.kr"), ("https://u:p@c.kr?z", "c.kr"), ("nohost", ""),
    ("https://한글.kr/가 나", "한글.kr")])
def test_host(spark, url, want):
    assert one(spark, U.host(F.lit(url)))[0] == want


@pytest.mark.parametrize("link,want", [
    ("../w?k=1", "https://a.b/x/w?k=1"), ("/r", "https://a.b/r"), ("//h/z", "https://h/z"), ("?n=1", "https://a.b/x/y/z?n=1"),
    ("http://o/p", "http://o/p"), ("", "https://a.b/x/y/z?q"), ("v/.", "https://a.b/x/y/v/"), ("../../../t", "https://a.b/t")])
def test_resolve(spark, link, want):
    assert one(spark, U.resolve(F.lit("https://a.b/x/y/z?q#f"), F.lit(link)))[0] == want


def test_redaction(spark):
    got = one(spark, U.redact_url(F.lit("https://x/p?ServiceKey=a b&q=1&empty&key=#f")), U.redact_url(F.lit("https://x/?key=")),
              U.redact_url(F.lit("ftp://x/?key=1")), U.query_param(F.lit("https://x/?df[id]=A%20b&df[id]=c"), "df[id]"),
              U.reference_kind(F.lit("https://kogl.or.kr/x")), U.reference_kind(F.lit("mailto:x")))
    assert list(got) == ["https://x/p?ServiceKey=%5BREDACTED%5D&q=1&empty=&key=#f", "https://x/?key=", "ftp://x/?key=1",
                         "A b", "license_reference", None]


def test_html(spark):
    h = ("<title>A &amp; B</title><script>var a='<a href=\"/no\">n</a>'</script><!-- <a href='/c'>c</a> -->"
         "<a href='/p;jsessionid=1?x=2'>L<img alt=\"pic\" src=i> m</a><a href='javascript:v'>j</a><a href=#t>t</a>"
         "<a href=mailto:q@x>m</a>&#54620;&#x41;&bogus; tail")
    got = one(spark, H.html_title(F.lit(h)), H.html_text(F.lit(h)), H.links(F.lit(h), F.lit("https://q.kr/d/")))
    assert got[0] == "A & B" and got[1] == "A & B L m j t m 한A&bogus; tail"
    assert [(x.url, x.label) for x in got[2]] == [("https://q.kr/p?x=2", "L pic m")]


def test_first_record_header(spark):
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows = [("이름,값\n1,2".encode("cp949"),), ("﻿이름,\"값\n둘\"\r\n1,2".encode(),), (b"<html>,a\n",), (b"\xff\xfea",),
            (b"a" * 70000,)]
    got = [r.h for r in spark.createDataFrame(rows, "b binary").select(T.first_record_header("b").alias("h")).collect()]
    assert (got[0].encoding, got[0].header) == ("cp949", ["이름", "값"])
    assert (got[1].encoding, got[1].header) == ("utf-8-sig", ["이름", "값\n둘"])
    assert [g.status for g in got[2:4]] == ["header_unresolved"] * 2 and not got[0].first_record_is_header_verified
    assert got[4].header == ["a" * 70000]
    cut = spark.createDataFrame(rows[4:], "b binary").select(T.first_record_header("b", 65536).alias("h")).first().h
    assert cut.status == "header_unresolved"


def test_long_csv_cells(spark):
    quoted = '"' + 'a""b,' * 200_000 + '"'
    many = ", ".join(["x"] * 100_000)
    got = one(spark, T.csv_cell(F.lit(quoted)), F.size(T.csv_cell(F.lit(many))), T.csv_cell(F.lit('a, "b"c')))
    assert got[0] == ['a"b,' * 200_000] and got[1] == 100_000 and got[2] == []


def test_metadata_flags_and_normalisation(spark):
    from catalith.functions.metadata import normalize_metadata
    df = spark.createDataFrame([("Té ", "<b>d</b>&amp;\x07", "a, ,b"), (None, "", None)], "t string, d string, k string")
    rows = normalize_metadata(df, "t", "d", "k").collect()
    assert rows[0].title_norm == "Té" and rows[0].description_norm == "d &" and rows[0].keyword_list == ["a", "b"]
    assert rows[1].title_norm is None and rows[0].t == "Té "
    f = df.select(T.metadata_flags(F.col("t"), F.col("d"), F.col("k"), F.lit("en")).alias("f")).collect()
    assert f[1].f == ["missing_title", "missing_description", "missing_keywords", "insufficient_metadata"]
