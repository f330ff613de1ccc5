"""Helpers the text operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.layout import spread

#: Rows and bytes of text handed to a Python worker at once.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20)}
#: A group is hot when it holds over 1/HOT_SHARE of the rows, so there are at most HOT_SHARE hot groups.
HOT_SHARE = 2000
HOT_LEAST = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for one block; the earlier values come back after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder with small Python batches, and return a reader over it."""
    with settings(df.sparkSession, BATCH):
        return materialize(df, tag)


def whole(df: DataFrame, *cols: Column | str) -> DataFrame:
    """The named columns of every row, dealt over the cores when the table has few files."""
    return spread(df.select(*cols))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % n


def chosen(rows: DataFrame, key: Column, bound: int) -> DataFrame:
    """About ``bound`` rows picked by a hash of ``key`` (all of them if there are fewer), the same on every run."""
    n = rows.count()
    if n <= bound:
        return rows
    return rows.filter(F.pmod(F.xxhash64(key.cast("string")), F.lit(1 << 30)) < int(bound / n * (1 << 30)))


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Join each row to the record of its group (inner), splitting hot groups.

    A group over 1/2000 of the rows is hot: there are 2000 of them at most, whatever
    the table's size, so their records are broadcast.  The others are joined by
    shuffle, where no key then holds more than that share.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    bound = max(HOT_LEAST, total // HOT_SHARE)
    hot, cold = groups.filter(F.col(size) > bound), groups.filter(F.col(size) <= bound)
    in_hot = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return in_hot.unionByName(rest)


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` minus the pairs (``k``, ``h``: hash of the text) in ``gone``; column names of ``docs`` may be any."""
    tagged = docs.withColumn("_catalith_h", text_hash(F.col("text")))
    out = gone.select(F.col("k").alias("_catalith_k"), F.col("h").alias("_catalith_d")).distinct()
    hit = (F.col("_catalith_h") == F.col("_catalith_d")) & F.col(key).eqNullSafe(F.col("_catalith_k"))
    return tagged.join(out, hit, "left_anti").drop("_catalith_h")


def single(docs: DataFrame, twice: DataFrame, same: Column) -> DataFrame:
    """``docs`` with one row (the least) of those that match the same row of ``twice`` by ``same``.

    ``twice`` names the few rows that repeat, in columns whose names begin with ``_catalith_``.
    """
    if twice.isEmpty():
        return docs
    row = F.struct(*docs.columns)
    one = docs.join(twice, same).groupBy(*twice.columns).agg(F.min_by(row, row).alias("_catalith_row")).select("_catalith_row.*")
    return docs.join(twice, same, "left_anti").unionByName(one)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))
