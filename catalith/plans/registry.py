"""Registry of the driver queries: Spark callable plus its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalith.layout import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale-factor folder, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def version(self, name: str) -> tuple:
        """Path, length and time of change of the table's files."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
        listed = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in listed))

    def spread(self, name: str) -> DataFrame:
        """The table with a split per core, for queries with heavy per-row work."""
        return spread(getattr(self, name))


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its SQL."""
    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return fn
    return add
