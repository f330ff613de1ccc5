"""Physical-layout helpers shared by the operators.

* ``dense_row_number`` numbers rows globally without a one-partition window.
* ``dictionary_join`` joins a large table to a small one: broadcast when the
  measured size allows it, otherwise a salted shuffle join that splits a hot key.
* ``shuffle_join`` joins two large tables without a broadcast, ``hash_join`` without a sort where the keys are few.
* ``page`` returns one page of an ordered result without sending everything
  before it through a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.durable import materialize

# Rows and bytes a broadcast side may have; measured, never assumed.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# Deepest row a TakeOrdered plan may carry through one task.
TAKE_ROWS = 50_000
SALTS = 16

_LOW33 = (1 << 33) - 1


def dense_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """Number rows 1..n in the total order ``order``.

    ``order`` should end in a unique key, so that range partitions split evenly
    even when the leading key is constant for a third of the rows.  Rows are
    range-partitioned and sorted once, the position inside each partition is
    written out, and a table with one row per partition supplies the offsets.
    """
    placed = materialize(place_rows(df, order), "rownum")
    return numbered(placed, place_offsets(placed), name)


def place_rows(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` in the order ``order`` with the place of each row, ``_pid`` and ``_pos``; to be written before it is read."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return (
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), 33).cast("int"))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
        .drop("_mid")
    )


def place_offsets(placed: DataFrame) -> DataFrame:
    """Rows before each partition.  One row per partition: bounded by the partition count, not by the data."""
    return (
        placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_off", F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("_pid", "_off")
    )


def numbered(placed: DataFrame, offsets: DataFrame, name: str) -> DataFrame:
    """The written rows of ``place_rows`` under their numbers, which start at 1."""
    return (
        placed.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off") + F.col("_pos") + 1).cast("long"))
        .drop("_pid", "_pos", "_off")
    )


def rank_within(df: DataFrame, group: str, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Number the rows of each ``group`` 1..n in ``order``, which should end in a unique key; a hot group is no single task."""
    numbered = dense_row_number(df, [group, *order], "_row").withColumn("_g", F.struct(group))
    before = numbered.groupBy("_g").agg((F.min("_row") - 1).alias("_before"))
    return dictionary_join(numbered, before, ["_g"]).withColumn(name, (F.col("_row") - F.col("_before")).cast("int")).drop("_g", "_row", "_before")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one split per core before heavy per-row work.

    A table of many files already has far more splits than cores and is returned
    untouched; only a table of a few files is dealt out, which moves little.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``rows`` rows and about ``size`` bytes.

    Each partition is read no further than ``rows + 1`` rows; the byte count is
    the length of the rows as JSON text.
    """
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    seen = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return seen["n"] <= rows and seen["b"] <= size


def shuffle_join(big: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two tables of any size, never by a broadcast.

    Spark broadcasts a side by its stored size; packed columns and exploded rows
    are many times larger once the driver has them.
    """
    return big.join(other.hint("merge"), list(on), how)


def hash_join(big: DataFrame, keys: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``big`` to a table of keys by shuffles; ``big`` is not sorted where a partition's share of the keys is small.

    Its share is measured: no more rows than a broadcast may have.  Beyond that both sides are sorted and merged.
    """
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if keys.count() > parts * BROADCAST_ROWS:
        return shuffle_join(big, keys, on, how)
    return big.join(keys.hint("shuffle_hash"), list(on), how)


def dictionary_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
    rows: int = BROADCAST_ROWS, salts: int = SALTS, fits: bool | None = None,
) -> DataFrame:
    """Join ``big`` to the dictionary ``small`` on the columns ``on``.

    Up to ``rows`` rows (and the byte bound) the dictionary is broadcast.  Beyond
    that each
    dictionary row is repeated ``salts`` times and the big side spreads its rows
    over the salts, so a key holding a third of ``big`` becomes ``salts`` groups;
    ``salts=1`` leaves a hot key to Spark's skew handling.
    ``how`` may be inner, left, left_semi or left_anti.  ``fits`` passes the
    result of an earlier size check of the same dictionary.
    """
    on = list(on)
    if fits_broadcast(small, rows) if fits is None else fits:
        return big.join(F.broadcast(small), on, how)
    if salts == 1:
        return hash_join(big, small, on, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # The salt must not change when a lost task runs again, so it is a hash of the
    # row; maps and variants cannot be hashed and are left out of it.
    hashable = [c for c, kind in big.dtypes if "map<" not in kind and "variant" not in kind]
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int"))
    return shuffle_join(salted_big, salted, [*on, "_salt"], how).drop("_salt")


def page(df: DataFrame, order: Sequence[str], number: int, size: int) -> DataFrame:
    """Rows ``(number-1)*size+1 .. number*size`` of ``df`` in the order ``order``.

    Shallow pages use Spark's ordered take.  Deep pages number the rows instead,
    because an ordered take carries every skipped row through one task.
    """
    if number < 1 or size < 1:
        raise ValueError("page number and size start at 1")
    skip = (number - 1) * size
    if skip + size <= TAKE_ROWS:
        return df.orderBy(*order).offset(skip).limit(size)
    numbered = dense_row_number(df, order, "_page_row")
    return (
        numbered.filter(F.col("_page_row").between(skip + 1, skip + size))
        .orderBy("_page_row").drop("_page_row")
    )


def page_count(total: Column, size: int) -> Column:
    """Number of pages of ``size`` rows needed for ``total`` rows."""
    return F.ceil(total / F.lit(size)).cast("long")


def set_digest(*cols: Column) -> list[Column]:
    """Aggregates that identify a multiset of rows: count and two 60-bit lanes.

    Sums combine on the map side, so comparing two hot groups never gathers
    either of them.  Put a position column first to make the digest ordered.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in cols]
    digest = F.sha2(F.concat_ws("\x1f", *parts), 256)

    def lane(start: int) -> Column:
        return F.sum(F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)"))

    return [F.count(F.lit(1)).alias("rows"), lane(1).alias("lane_a"), lane(16).alias("lane_b")]
