"""The near stage links by SimHash fingerprints as well as by shingle similarity."""

import random

import corpus_pipeline
from catalith.llm import near_copies, simhash


def test_stage_links_fingerprints_that_shingle_sets_miss(spark):
    rng = random.Random(3)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    often, other = " ".join([words(7)] * 200), words(80)
    texts = [f"{often} {words(20)}", f"{often} {words(20)}", other, other + " end", words(80), "", None]
    a, b = texts[:2]
    fps = simhash.fingerprints([a, b])
    assert int(fps[0] ^ fps[1]).bit_count() <= simhash.BUDGET
    assert near_copies.similarity(near_copies.shingle_set(a), near_copies.shingle_set(b)) < near_copies.LEAST
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "")
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 2, 4, 5]
    assert near_copies.similar_groups(docs.limit(0), budget=simhash.BUDGET).count() == 0
