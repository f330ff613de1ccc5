"""The corpus pipeline as a query."""

from __future__ import annotations

import corpus_pipeline
from catalith.llm.registry import query

query("pipeline", corpus_pipeline.ORACLE_SQL)(lambda spark, folder: corpus_pipeline.run(spark, folder))
