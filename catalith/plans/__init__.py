"""The registered queries of the library over the given tables."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from catalith.plans.registry import ORACLES, QUERIES

_MODULES = ("lexical", "web", "documents", "graph", "governance", "ranking", "reconciling", "exports", "files")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"catalith.plans.{name}")


def queries() -> dict[str, Callable]:
    _load()
    return dict(sorted(QUERIES.items()))


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(sorted(ORACLES.items()))
