import numpy as np
import pyarrow as pa

from catalith.llm import hard_negatives as hn


def test_a_chunk_is_merged_once(monkeypatch):
    """What is kept was sorted again for every label, place and threshold of a chunk."""
    rng, calls, merge = np.random.default_rng(3), [], hn.best
    x = rng.integers(-50, 50, (600, 8))
    ident, label = np.arange(600), np.arange(600) % 10
    batch = pa.record_batch({"k": pa.array(ident), "label": pa.array(label), "v": pa.array(list(x))})
    own = np.flatnonzero(ident % 20 == 0)
    a = {8: {"no": np.arange(len(own)), "k": ident[own], "label": label[own], "v": x[own]}}
    monkeypatch.setattr(hn, "best", lambda *args: calls.append(1) or merge(*args))
    (got,) = hn.positives_of(iter([batch]), a, 5)
    assert len(calls) == 1
    score = x[own] @ x.T
    want = {(n, int(i), int(score[n, i])) for n, o in enumerate(own) for i in sorted(
        np.flatnonzero((label == label[o]) & (ident != o)), key=lambda i: (-score[n, i], i))[:5]}
    assert set(zip(*(got.column(i).to_pylist() for i in range(3)), strict=True)) == want
    high = np.sort([[s for m, _, s in want if m == n] for n in range(len(own))], axis=1)[:, ::-1]
    a[8]["high"], a[8]["low"] = high, -((-80 * high) // 100)
    calls.clear()
    (got,) = hn.negatives_of(iter([batch]), a, 5)
    assert len(calls) == 1
    want = set()
    for n, o in enumerate(own):
        for p in range(5):
            fit = np.flatnonzero((label != label[o]) & (score[n] <= high[n, p]) & (100 * score[n] >= 80 * high[n, p]))
            want |= {(n, p + 1, int(i), int(score[n, i])) for i in sorted(fit, key=lambda i: (-score[n, i], i))[:5]}
    assert set(zip(*(got.column(i).to_pylist() for i in range(4)), strict=True)) == want
