"""Operators for preparing training text; nothing else in the library imports this package."""

from __future__ import annotations

import importlib

from catalith.llm.registry import ORACLES, QUERIES

_MODULES = ("toxicity", "byte_bpe", "simhash", "embedding_dups", "packing", "token_counts", "language",
            "token_files", "sharding", "exact_dedup", "hard_negatives", "secrets", "spelling", "pipeline_query")


def queries() -> dict:
    for name in _MODULES:
        importlib.import_module(f"catalith.llm.{name}")
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLES)
