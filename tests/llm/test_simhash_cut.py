"""The trie cut collects a bounded table however many nodes are too full."""

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from catalith.llm import simhash  # noqa: E402


def test_cut_collects_a_bounded_table(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TABLE", 256, raising=False)
    fp = np.unique(np.random.default_rng(6).integers(-(1 << 63), 1 << 63, 1500))
    nodes = spark.createDataFrame([(int(x),) for x in fp], "fp long")
    sizes, collect = [], type(nodes).collect

    def counted(df):
        rows = collect(df)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(type(nodes), "collect", counted)
    cut = simhash.cut_trie(nodes, 16)
    monkeypatch.undo()
    assert max(sizes) <= 256
    starts = np.array([p << (64 - d) for p, d in cut], dtype=np.uint64)
    held = np.bincount(np.searchsorted(starts, fp.view(np.uint64), side="right") - 1, minlength=len(cut))
    assert held.max() <= 16 and held.min() >= 1 and held.sum() == len(fp)
    assert len(cut) == len(simhash.cut_trie(nodes, 16))
