"""The near-copy stage of the pipeline against all pairs by true five-word similarity."""

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from catalith.llm import near_copies, registry, simhash  # noqa: E402


def edited(rng, words, edits):
    out = list(words)
    for i in rng.choice(len(out), edits, replace=False):
        out[i] = f"new{rng.integers(1 << 30)}"
    return out


def planted():
    """Pairs from 0.8 to 0.95, pairs below, a chain, one hot group, texts without words, null keys, repeated rows."""
    rng = np.random.default_rng(4)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    texts = []
    for size, edits in ((200, 2), (400, 7), (1000, 5), (1000, 20), (300, 20), (200, 15)):
        for _ in range(4):
            base = fresh(size)
            texts += [base, edited(rng, base, edits)]
    step = fresh(300)
    for _ in range(8):
        texts.append(step)
        step = edited(rng, step, 5)
    hot = fresh(300)
    texts += [edited(rng, hot, int(rng.integers(1, 12))) for _ in range(60)]
    texts = [" ".join(t) for t in texts] + ["", " ", "\n", None, "two words", "Two  words", "two word"]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    return [*rows, (None, texts[0], "y"), rows[2], (9999, texts[2].upper(), "z")]


def plain(rows):
    """Smallest key of the component of every row, by all pairs."""
    sets = [set(simhash.shingle_hashes(t or "", 5)) for _, t, _ in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if not union or len(sets[i] & sets[j]) / union >= 0.8:
                root[top(i)] = top(j)
    least = {}
    for i, (k, _, _) in enumerate(rows):
        if k is not None:
            least[top(i)] = min(k, least.get(top(i), k))
    return [least.get(top(i)) for i in range(len(rows))]


def test_stage_keeps_one_of_each_similar_group(spark):
    registry.on_workers(spark)
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    want = plain(rows)
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(want))
    assert near_copies.similar_groups(docs.limit(0)).count() == 0


def test_blocks_within_buckets_lose_no_link(spark, monkeypatch):
    registry.on_workers(spark)
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    # One band for all that is not wordless: everything then rests on the comparison within a bucket.
    table = near_copies._table
    one = "case when size(bands) = 0 then bands else array(1L) end as bands"
    monkeypatch.setattr(near_copies, "_table", lambda *a: table(*a).selectExpr("k", "h", "node", one))
    got = sorted(((r["k"], r["component"]) for r in near_copies.similar_groups(docs, block=7).collect()), key=str)
    assert got == sorted(zip((r[0] for r in rows), plain(rows)), key=str)
