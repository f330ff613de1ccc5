"""The stages that drop copies, on tables whose columns bear the names the operators use inside."""

import pytest

pytest.importorskip("public_tokenizers")

from catalith.llm import exact_dedup, near_copies, registry, simhash  # noqa: E402

NAMES = ("_k", "_h", "_s", "k", "h", "sha", "c", "component", "node", "n")
ROWS = [(1, "one two three four five six"), (2, "ONE two three four five six"), (3, "another text of some words here"), (3, "another text of some words here"),
        (4, None), (None, ""), (5, "")]


@pytest.mark.parametrize("keep", [exact_dedup.drop_copies, simhash.keep_one, lambda d: simhash.keep_one(d, groups=near_copies.similar_groups)])
def test_kept_rows(spark, keep):
    registry.on_workers(spark)
    docs = spark.createDataFrame([(k, t, *(["v"] * len(NAMES))) for k, t in ROWS], "doc_id long, text string, " + ", ".join(f"{n} string" for n in NAMES))
    got = keep(docs)
    assert got.columns == docs.columns
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in got.collect())
    exact = keep is exact_dedup.drop_copies
    assert [k for k, _ in kept] == ([2, 3, 5] if exact else [1, 3, 4])
