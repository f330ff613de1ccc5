"""Links of a table with a third of its rows in one noisy group."""

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from catalith.llm import embedding_dups, registry  # noqa: E402


def test_dense_group_keeps_its_links(spark):
    registry.on_workers(spark)
    rng = np.random.default_rng(9)
    centre = rng.standard_normal(32)
    x = np.concatenate([centre + 0.2 * rng.standard_normal((1000, 32)), rng.standard_normal((2000, 32))])
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = {r["k"]: r["n_links"] for r in embedding_dups.near_vectors(df, leaf=32, block=256).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    assert want[:1000].min() > 500
    assert sum(got.values()) >= embedding_dups.RECALL * want.sum()
    assert all(got[i] <= want[i] for i in range(len(x)))
