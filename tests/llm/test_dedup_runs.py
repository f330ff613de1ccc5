"""Several runs of exact deduplication on one state, against a plain count over all rows seen so far."""

import os

import pytest

from catalith.llm import exact_dedup as ed
from tests.oracle_compare import compare, connect

FOLDER = os.environ.get("CATALITH_TEST_DIR", "/root/testdata/sf0.001")

RUNS = [[(1, "Alpha"), (2, "alpha"), (3, None), (4, "beta"), (5, "unique one")],
        [(6, "ALPHA"), (7, ""), (8, "gamma"), (9, "beta "), (0, "beta")],
        [],
        [(10, "gamma"), (None, "alpha"), (11, "Gamma"), (12, "öÖ"), (13, "öö"), (13, "öö")]]


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("digits", [64, 1])
def test_later_runs_continue(spark, tmp_path, digits):
    # One hex digit: 16 digests, so unequal texts meet within runs and across them.
    seen, state = [], str(tmp_path / "state")
    for rows in RUNS:
        seen += rows
        got = ed.groups(spark.createDataFrame(rows, "doc_id long, text string"), state=state, digits=digits)
        want = []
        for k, text in rows:
            same = [i for i, t in seen if low(t) == low(text)]
            want.append((k, max((i for i in same if i is not None), default=None), len(same)))
        order = lambda r: tuple(-1 if x is None else x for x in r)
        assert sorted([(r.k, r.keep_k, r.n) for r in got.collect()], key=order) == sorted(want, key=order)


def test_the_place_of_a_content_holds_it(spark, tmp_path):
    state = str(tmp_path / "state")
    for rows in RUNS[:2]:
        ed.groups(spark.createDataFrame(rows, "doc_id long, text string"), state=state).count()
    index = spark.read.parquet(f"{state}/index")
    for r in index.filter("n > 1").select("digest", "keep.k", "keep.place").distinct().collect():
        held = spark.read.parquet(r.place).filter(f"k = {r.k} AND digest = '{r.digest}'").collect()
        assert len(held) == 1


def test_without_a_state_nothing_is_kept(spark):
    docs = spark.createDataFrame(RUNS[0], "doc_id long, text string")
    for _ in range(2):
        assert sorted((r.k, r.keep_k, r.n) for r in ed.groups(docs).collect()) == [(1, 2, 2), (2, 2, 2), (3, 3, 1), (4, 4, 1), (5, 5, 1)]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_equals_its_sql(spark):
    _, difference = compare(spark, connect(FOLDER), FOLDER, ed.op10, ed.SQL)
    assert difference is None, difference
