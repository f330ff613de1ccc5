"""The corpus pipeline: toxicity, language, exact copies, near copies, packing.

Each stage takes the documents its predecessor kept and returns those it keeps, with
their columns; the last returns the packed pieces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalith.durable import scratch_root
from catalith.llm import exact_dedup, language, near_copies, packing, simhash, toxicity
from catalith.llm.common import BATCH, settings
from catalith.llm.registry import on_workers


def _stage(keep: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return keep(spark, docs, sf_dir.rstrip("/"))
    return run_stage


def _near(docs: DataFrame, key: str) -> DataFrame:
    """SimHash links as in op3, and beside them the links of similar five-word shingles, which scattered edits need."""
    return near_copies.similar_groups(docs, key, budget=simhash.BUDGET)


STAGES = [
    ("toxicity", _stage(lambda spark, docs, sf_dir: toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))),
    ("language", _stage(lambda spark, docs, sf_dir: language.drop_unknown(docs))),
    ("exact_dedup", _stage(lambda spark, docs, sf_dir: exact_dedup.drop_copies(docs))),
    ("near_dedup", _stage(lambda spark, docs, sf_dir: simhash.keep_one(docs, groups=_near))),
    ("packing", _stage(lambda spark, docs, sf_dir: packing.packed_documents(docs))),
]

#: Learned scores, fingerprints and token ids have no SQL form; the tests hold near_dedup against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    root = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        with settings(spark, BATCH):
            stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}-{name}")
        docs = spark.read.parquet(f"{root}/{k}-{name}")
    return docs
