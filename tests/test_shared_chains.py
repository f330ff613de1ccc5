"""Counting shared schemas: rounds, cycles and counts beyond the type."""

import pytest

from catalith.durable import materialize as write
from catalith.operators import shared_schemas as S
from tests.test_shared_schemas import api, docs, ref


def test_jobs_do_not_follow_the_length_of_a_chain(spark, monkeypatch):
    written = []
    monkeypatch.setattr(S, "materialize", lambda df, tag: written.append(tag) or write(df, tag))
    rounds = []
    for n in (3, 30):
        chain = {f"S{k}": {"properties": {"l": ref(f"S{k + 1}"), "r": ref(f"S{k + 1}")}} for k in range(n)} | {f"S{n}": {"type": "string"}}
        rows = S.openapi_counts(docs(spark, api(chain, ref("S0")))).filter("output_fields > 0").collect()
        assert [int(r.output_fields) for r in rows] == [2**n]
        rounds.append(len(written))
        written.clear()
    assert rounds[0] == rounds[1]


def test_counts_of_one_graph():
    end = lambda node, *own: (None, node, None, None, None, *own)
    use = lambda node, target, given, n: (None, node, target, given, n, None, None, None, None)
    root = ("op", "r", *[None] * 7)
    ends = [end("r", 0, 0, 0, 0), end("a", 1, 2, 3, 4)]
    assert S.graph_counts([root, use("r", "a", 0, 1), *ends]) == {"op": (1, 1, 7)}
    assert S.graph_counts([root, use("r", "a", 1, 2), *ends]) == {"op": (1, 2, 8)}
    assert S.graph_counts([root, root, use("r", "a", 2, 1), use("a", "gone", 0, 5), *ends]) == {"op": (2, 12, 18)}
    assert S.graph_counts([root, use("r", "a", 0, 1), use("a", "a", 2, 1), *ends]) is None
    assert S.graph_counts([root, use("a", "a", 2, 1), *ends]) == {"op": (1, 0, 0)}


def test_a_count_beyond_the_type_is_an_error():
    with pytest.raises(OverflowError):
        S._count(10**38)
