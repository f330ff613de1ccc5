"""run() and the stages of the pipeline on the smallest tables, against plain Python."""

import os
import re
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from catalith.durable import materialize  # noqa: E402
from catalith.llm import toxicity  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def same(a, b):
    return (a == b) if not (a and b) else len(a & b) >= 0.8 * len(a | b)


def test_stages_against_plain_python(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, [texts(docs)]
    whole = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = materialize(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        seen.append(texts(docs))
        assert seen[-1].items() <= seen[-2].items()
    start, clean, known, unique, left = seen
    # The two learned stages drop exactly what their operators mark.
    grammar = toxicity.fit(toxicity.labelled_rows(whole, spark.read.parquet(f"{FOLDER}/labels.parquet")))
    scores = {r["doc_id"]: r["s"] for r in whole.select("doc_id", toxicity.toxicity(grammar, whole["text"])["score"].alias("s")).collect()}
    assert clean.keys() == {k for k, s in scores.items() if s < 0.7}
    assert known.keys() >= {k for k, t in clean.items() if t and re.search(r"[a-z]{4,} [a-z]{4,}", t)}
    assert not any(not re.search(r"[^\W\d_]", clean[k] or "") for k in known)
    # Of equal texts the largest doc_id stays.
    best = {}
    for k, t in known.items():
        best[lowered(t)] = max(k, best.get(lowered(t), k))
    assert set(unique) == set(best.values())
    # Near copies: one document stays of each group linked by five-word similarity of 0.8.
    words = {k: shingles(t) for k, t in unique.items()}
    keys = sorted(words)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if same(words[a], words[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {find(k) for k in keys}
    assert len(left) == len(groups) == len({find(k) for k in left})
    # Packing: every id of every document once, in sequences without gaps.
    pieces = [r.asDict() for r in corpus_pipeline.STAGES[4][1](spark, docs, FOLDER).collect()]
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert by_doc.keys() == left.keys()
    for k, mine in by_doc.items():
        ids = np.array([*tok.encode(left[k] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for p in sorted(mine, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for mine in by_sequence.values():
        at = 0
        for p in sorted(mine, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024


def test_run_applies_all_stages(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(rows.columns)
    assert 0 < rows.select("doc_id").distinct().count() < spark.read.parquet(f"{FOLDER}/documents.parquet").count()
