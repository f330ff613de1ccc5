"""Registry of this package's queries."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(spark, folder) -> DataFrame``, with its SQL where SQL can express it."""
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            on_workers(spark)
            return fn(spark, folder.rstrip("/"))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    # Memory that a batch no longer needs goes back at once: workers live on from stage to stage.
    for name, value in (("ARROW_DEFAULT_MEMORY_POOL", "system"), ("MALLOC_ARENA_MAX", "2"), ("MALLOC_TRIM_THRESHOLD_", "1048576")):
        spark.sparkContext.environment.setdefault(name, value)
