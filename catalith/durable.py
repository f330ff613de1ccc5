"""Lineage cuts that survive a lost executor.

Iterative operators (graph expansion, closure, state scans) and row numbering
need a result that is fixed once and read several times.  They write it as
Parquet to the folder named by ``spark.checkpoint.dir`` -- shared storage on a
cluster -- so a lost executor costs a re-read, not a recomputation, and later
readers still get column pruning.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_WRITTEN: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode with the setting absent
    (tests); on a cluster a missing setting is an error, because a machine-local
    folder is not visible to the other executors.
    """
    root = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {_CONF} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="spark-catalith-", dir="/tmp")
    spark.conf.set(_CONF, root)
    return root


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables this process wrote; their readers end here."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        done += bool(path.getFileSystem(conf).delete(path, True))
    return done


def materialize(df: DataFrame, tag: str = "t", by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and return a reader over the written files, in folders by the columns ``by``."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "snappy").partitionBy(*by).parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)
