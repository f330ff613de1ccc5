"""Navigation candidates and referrals keep every link and whole labels; the display view cuts them."""

from catalith.operators import registry as rg


def test_all_links_and_whole_labels(spark):
    long = "데이터셋 " + "x" * 300
    rows = [(s, "https://a.kr/", f"https://a.kr/{i}", f"{long}{i}", i) for i in range(40) for s in (1, None)]
    links = spark.createDataFrame(rows, "id int, page string, url string, label string, pos int")
    args = (links, "id", "page", "url", "label", "pos")
    got = rg.navigation_candidates(*args).collect()
    assert sorted((r["id"] or 0, r["rank"], r["label"]) for r in got) == sorted((s or 0, i + 1, label) for s, _, _, label, i in rows)
    shown = rg.navigation_display(*args).collect()
    assert sorted((r["id"] or 0, r["rank"]) for r in shown) == sorted((s, k) for s in (0, 1) for k in range(1, 25))
    assert {len(r["label"]) for r in shown} == {200}
    other = links.selectExpr("id", "page", "'https://b.kr/' as url", "label", "pos")
    assert {r["link_label"] for r in rg.host_referrals(other, "id", "page", "url", "label", "pos").collect()} == {f"{long}0"}
