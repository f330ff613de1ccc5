import numpy as np
import pytest

from catalith.operators import pruned_knn as pk
from catalith.operators import retrieval as rt

SCHEMA = "id long, model string, vec array<double>"
ASKED = "query_id long, model string, vec array<double>"


def clustered(n, dim, groups, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dim))
    return [(centres[i % groups] + 0.05 * r.normal(size=dim)).tolist() for i in range(n)]


def pairs(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("block", [7, 2_048])
def test_equals_all_pairs_and_compares_fewer(spark, block):
    vecs = clustered(1_500, 12, 10, 1)
    # A third of the rows is one vector, ids and all rows of it repeated once.
    rows = [(i, "m1", v) for i, v in enumerate(vecs)] + [(5_000 + i % 250, "m1", vecs[3]) for i in range(500)]
    corpus = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame([(i, "m1", vecs[i]) for i in range(0, 1_500, 60)], ASKED)
    found = pk.pruned_knn(asked, pk.build_cells(corpus, 32), 6, query_rows=block)
    assert pairs(found.rows) == pairs(rt.knn(asked, corpus, 6))
    assert found.pairs == 25 * 2_000
    assert found.compared < found.pairs / 3


def test_spread_vectors_lose_nothing(spark):
    r = np.random.default_rng(2)
    rows = [(i, "ab"[i % 2], r.normal(size=8).tolist()) for i in range(600)]
    corpus = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame([(i, m, v) for i, m, v in rows[::50]] + [(-1, "a", (-np.array(rows[0][2])).tolist())], ASKED)
    found = pk.pruned_knn(asked, pk.build_cells(corpus, 16), 5)
    assert pairs(found.rows) == pairs(rt.knn(asked, corpus, 5))
    # More asked for than a model has: everything comes back.
    assert pk.pruned_knn(asked.limit(2), pk.build_cells(corpus, 4), 1_000).rows.count() == 600


def test_rows_that_cannot_score_take_no_part(spark):
    rows = [(1, "m", [1.0, 0.0]), (2, "m", [0.0, 0.0]), (3, "m", None), (4, "m", [None, 1.0]), (5, None, [1.0, 0.0]),
            (None, "m", [1.0, 0.0]), (6, "m", [float("nan"), 1.0]), (7, "m", []), (8, "m", [1.0, 0.0, 0.0]), (9, "m", [float("inf"), 1.0])]
    corpus = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame([(1, "m", [1.0, 1.0]), (2, "other", [1.0, 1.0]), (3, "m", None), (4, None, [1.0, 1.0])], ASKED)
    found = pk.pruned_knn(asked, pk.build_cells(corpus), 3)
    assert [(r.query_id, r.id) for r in found.rows.collect()] == [(1, 1)]


def test_models_beyond_the_centres_and_empty_tables(spark):
    rows = [(i, f"m{i}", [1.0, float(i)]) for i in range(20)]
    corpus = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame(rows, ASKED)
    found = pk.pruned_knn(asked, pk.build_cells(corpus, 3), 2)
    assert [(q, i) for q, _, i, _ in pairs(found.rows)] == [(i, i) for i in range(20)]
    assert pk.pruned_knn(asked.limit(0), pk.build_cells(corpus), 2).rows.count() == 0
    assert pk.pruned_knn(asked, pk.build_cells(corpus.limit(0)), 2).rows.count() == 0


def test_the_scan_lists_its_cells(spark):
    vecs = clustered(400, 6, 8, 5)
    cells = pk.build_cells(spark.createDataFrame([(i, "m", v) for i, v in enumerate(vecs)], SCHEMA), 16)
    asked = {"6:m": (np.array([1]), np.array([vecs[0]]))}
    plan = pk._scan_cells(cells, asked, {"6:m": {3: np.array([True])}}, 2, "query_id long, id long, score double", None)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in text or "PartitionFilters: [(cell" in text or "PartitionFilters: [cell" in text
    assert "Exchange" not in text
