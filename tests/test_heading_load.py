import random

import pytest

from catalith.operators import scan as sc


def plain(rows):
    """Section and operation of each element, one after the other."""
    out, page, section, operation = {}, object(), None, None
    for n, (p, pos, level, label) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1])), 1):
        if p != page:
            page, section, operation = p, None, None
        if level == 3:
            section, operation = label, None
        elif level == 4 and label not in (None, "no"):
            operation = label
        out[p, pos] = (n, section, operation)
    return out


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_headings_of_short_hot_and_null_pages(spark, hot):
    rnd = random.Random(5)
    pages = [None if k % 50 == 7 else 40 if rnd.random() < hot else k // 4 for k in range(3000)]
    rows = [(p, k, rnd.choice([None, None, None, None, 1, 3, 4]), rnd.choice([None, "no", "a", "b", "c"])) for k, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page int, pos int, level int, label string").repartition(4)
    got = sc.heading_scope(df, "page", "pos", "level", "label", ("no",), number="n")
    assert {(r.page, r.pos): (r.n, r.section, r.operation) for r in got.collect()} == plain(rows)


def test_headings_far_above_in_a_hot_page(spark):
    """A heading reaches over range partitions that hold no heading at all."""
    df = spark.range(20000).selectExpr("'p' page", "id pos", "case id when 0 then 3 when 1 then 4 end level", "'h' || id label")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sc.heading_scope(df, "page", "pos", "level", "label")
        assert got.columns == ["page", "pos", "level", "label", "section", "operation"]
        assert got.filter("section = 'h0' and operation = 'h1'").count() == 19999
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_short_blocks_leave_the_scan_at_once(spark, monkeypatch):
    """Only blocks at the edge of a chunk are carried on: two a chunk, not one a block."""
    sizes, inner = [], sc._scan

    def counted(elems, rows, *rest):
        sizes.append(elems.count())
        return inner(elems, rows, *rest)

    monkeypatch.setattr(sc, "_scan", counted)
    from pyspark.sql import functions as F
    df = spark.range(2000).selectExpr("id div 2 as b", "id", "if(id % 2 = 0, id, null) v")
    got = sc.carry_down(df, "b", ["id"], F.col("v"), "got", chunk=16)
    assert got.filter("got = id - id % 2").count() == 2000
    assert sizes[0] == 2000 and sizes[1] <= 2 * 125
