import pytest
from pyspark.sql import functions as F

from catalith import durable
from catalith import layout as ly
from catalith.operators import reconcile as rc
from catalith.operators import registry as rg
from catalith.operators import search as se


def test_row_numbers_with_a_constant_leading_key(spark):
    df = spark.range(0, 20000).select(F.lit("hot").alias("k"), ((F.col("id") * 7919) % 20000).alias("u"))
    got = ly.dense_row_number(df, ["k", "u"], "n")
    assert got.filter(F.col("n") != F.col("u") + 1).count() == 0


def test_dictionary_join_broadcast_and_salted_agree(spark):
    big = spark.range(0, 5000).select((F.when(F.col("id") < 2000, 1).otherwise(F.col("id") % 97)).alias("k"), "id")
    small = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = ly.dictionary_join(big, small, ["k"], how)
        b = ly.dictionary_join(big, small, ["k"], how, rows=10)
        assert rc.table_difference(a, b.select(*a.columns)).count() == 0
        plan = b._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" in plan


def test_deep_pages_match_shallow_pages(spark, monkeypatch):
    df = spark.range(0, 1000).select((1000 - F.col("id")).alias("k"))
    want = [r.k for r in ly.page(df, ["k"], 7, 24).collect()]
    monkeypatch.setattr(ly, "TAKE_ROWS", 10)
    assert [r.k for r in ly.page(df, ["k"], 7, 24).collect()] == want == list(range(145, 169))
    with pytest.raises(ValueError):
        ly.page(df, ["k"], 0, 24)


def test_scratch_root_follows_the_session(spark, tmp_path, monkeypatch):
    durable.scratch_root(spark)
    monkeypatch.setattr(durable, "_CONF", "spark.catalith.test.dir")
    spark.conf.set("spark.catalith.test.dir", str(tmp_path) + "/")
    assert durable.scratch_root(spark) == str(tmp_path)
    durable.materialize(spark.range(3)).count()
    assert any(p.name.startswith("t-") for p in tmp_path.iterdir())


def test_search_validation(spark):
    items = spark.createDataFrame([(i, "p", "r", "catalog_label", f"l{i}%", None, ["c"] if i % 2 else []) for i in range(60)],
                                  "id int, portal_id string, record_id string, kind string, label string, name_en string, concept_ids array<string>")
    known = spark.createDataFrame([("p",)], "portal_id string")
    concepts = spark.createDataFrame([("c",)], "id string")
    for bad in (dict(mode="x"), dict(basis="x"), dict(number=0), dict(number=1_000_001), dict(portal="zz", portals=known), dict(concept="zz", concepts=concepts)):
        with pytest.raises(ValueError):
            se.search_items(items, **bad)
    r = se.search_items(items, q="L1", mode="all")
    assert r.totals().collect()[0].total == 11
    assert se.search_items(items).totals().collect()[0].pages == 2
    assert [x.id for x in se.search_items(items, mode="all", number=3).rows.collect()] == list(range(48, 60))
    assert se.search_items(items, concept="c", mode="all").totals().collect()[0].total == 30


def test_header_candidate_search(spark):
    docs = spark.createDataFrame([("d1", '{"header_candidates":["인구수"]}'), ("d2", '{"declared_parameter_lists":[{"response_name_candidates":["pop_cnt"]}]}'), ("d3", "{}")],
                                 "path string, j string").select("path", F.parse_json("j").alias("metadata"))
    src = spark.createDataFrame([("d1", "r1"), ("d2", "r2"), ("d3", "r3")], "path string, record_id string")
    empty = spark.createDataFrame([], "record_id string, name string, name_en string")
    hit = lambda q: {r.record_id for r in se.records_with_field(empty, empty, q, docs, src).collect()}
    assert hit("인구") == {"r1"} and hit("POP%") == {"r2"}


def test_pagination_and_two_pass(spark):
    rows = [("p", 1, 3, "a", True), ("p", 1, 3, "b", True), ("p", 2, 3, "b", True), ("p", 2, 3, "c", True),
            ("f", 1, 1, "a", True), ("f", 2, 1, None, False), ("t", 1, 2, "a", True), ("t", 2, 3, "b", True)]
    df = spark.createDataFrame(rows, "portal string, page int, total int, rec string, ok boolean")
    got = {r.portal: (r.received, r.unique_records, r.duplicates, r.complete) for r in rc.pagination_report(df, "portal", "page", "total", "rec", "ok").collect()}
    assert got == {"p": (4, 3, 1, True), "f": (1, 1, 0, False), "t": (2, 2, 0, False)}
    p = spark.createDataFrame([("s", 1, "a", 3), ("s", 1, "b", 3), ("s", 2, "b", 3), ("s", 2, "c", 3)], "s string, run int, rec string, total int")
    r = rc.two_pass_reconcile(p, "s", "run", "rec", "total").collect()[0]
    assert (r.union_records, r.seen_in_one_pass, r.complete) == (3, 2, True)


def test_registry_rules(spark):
    df = spark.createDataFrame([("page_observed", "접속 확인", "u", "x" * 300), ("page_observed", "t", "u", "x" * 300), ("page_observed", "t", "u", "x"),
                                ("page_observed", "Index", "u", "x"), ("fetch_unresolved", None, None, None)], "s string, t string, u string, x string")
    got = [r[0] for r in df.select(rg.observation_status(F.col("s"), F.col("t"), F.col("u"), F.col("x"))).collect()]
    assert got == ["interstitial_observed", "body_observed", "title_only", "response_only", "fetch_unresolved"]
    links = spark.createDataFrame([(1, "https://a.kr/", "https://a.kr/d", "공공데이터 목록", 1), (1, "https://a.kr/", "https://a.kr/d", "데이터셋", 2),
                                   (1, "https://a.kr/", "https://a.kr/n", "데이터셋 공모전", 3), (1, "https://a.kr/", "https://b.kr/", "데이터셋", 4)],
                                  "id int, page string, url string, label string, pos int")
    nav = rg.navigation_candidates(links, "id", "page", "url", "label", "pos").collect()
    assert [(r.url, r.label) for r in nav] == [("https://a.kr/d", "데이터셋")]
    leads = {r.url: r.likely_notice for r in rg.lead_merge(links, "url", "label", "id").collect()}
    assert leads == {"https://a.kr/d": False, "https://a.kr/n": True, "https://b.kr/": False}
    s = spark.createDataFrame([("서울특별시", "body_observed"), ("서울특별시 종로구", "title_only"), ("서울특별시청", "body_observed")], "region string, observation_status string")
    r = rg.regional_coverage(s, spark.createDataFrame([("서울특별시",), ("부산광역시",)], "region string"))
    assert {x.region: (x.services, x.body_observed) for x in r.collect()} == {"서울특별시": (2, 1), "부산광역시": (0, 0)}


def test_set_and_digest_checks(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "v string")
    b = spark.createDataFrame([("x",), ("z",)], "v string")
    r = rc.set_relation(a, b, "v").collect()[0]
    assert (r.left_values, r.right_values, r.only_left, r.only_right, r.equal) == (2, 2, 1, 1, False)
    assert {(x.v, x.left_copies, x.right_copies) for x in rc.multiset_difference(a, b, "v").collect()} == {("x", 2, 1), ("y", 1, 0), ("z", 0, 1)}
    rows = spark.createDataFrame([("t1", 1, "a"), ("t1", 2, "b"), ("t2", 2, "b"), ("t2", 1, "a"), ("t3", 1, "b"), ("t3", 2, "a")], "t string, p int, c string")
    assert {(x.t, x.is_first) for x in rc.duplicate_tables(rows, ["t"], "p", ["c"]).collect()} == {("t1", True), ("t2", False)}


@pytest.mark.parametrize("rows", [15, 16, 17, 255, 256, 257])
def test_carry_down_at_chunk_edges(spark, rows):
    from catalith.operators.scan import carry_down

    df = spark.range(1, rows + 1).selectExpr("'b' as b", "id", "if(id = 1, 'first', null) as v")
    out = carry_down(df, "b", ["id"], F.col("v"), "got", chunk=16)
    assert out.filter("got = 'first'").count() == rows
