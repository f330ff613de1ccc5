"""Ordered scans over groups of any size.

A running fold over an ordered group normally needs the whole group in one task.
When the fold is associative it can be cut into chunks: fold each chunk, fold the
chunk totals the same way, and add the carried-in value back.  A group holding a
third of all rows is then many chunks on many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.layout import dense_row_number, place_offsets, place_rows

CHUNK = 256


def segmented_scan(
    df: DataFrame, block: str, order: Sequence[str], element: Column,
    combine: Callable[[Column, Column], Column], identity: Column,
    out: str = "before", chunk: int = CHUNK,
) -> DataFrame:
    """Add ``out``: the fold of ``element`` over the earlier rows of the same block.

    ``combine`` must be associative with ``identity`` as its neutral element, and
    ``order`` must be unique inside a block.
    """
    numbered = dense_row_number(df.withColumn("_e", element), [block, *order], "_idx")
    rows = numbered.count()
    before = _scan(numbered.select(F.col(block).alias("_b"), "_idx", "_e"), rows, combine, identity, chunk)
    return (numbered.join(before, (numbered[block].eqNullSafe(before["_b"])) & (numbered["_idx"] == before["_i"]))
            .select(*[numbered[c] for c in df.columns], F.col("_before").alias(out)))


def _scan(elems: DataFrame, rows: int, combine: Callable[[Column, Column], Column],
          identity: Column, chunk: int) -> DataFrame:
    # A group below is one block's share of one chunk: at most ``chunk`` rows.
    grouped = (elems.withColumn("_c", F.floor((F.col("_idx") - 1) / chunk) + 1)
               .groupBy("_b", "_c").agg(F.array_sort(F.collect_list(F.struct("_idx", "_e"))).alias("_items")))
    start = F.struct(
        F.slice(F.transform("_items", lambda x: F.struct(x["_idx"].alias("i"), x["_e"].alias("v"))), 1, 0).alias("out"),
        identity.alias("acc"))
    folded = F.aggregate("_items", start, lambda s, x: F.struct(
        F.array_append(s["out"], F.struct(x["_idx"].alias("i"), s["acc"].alias("v"))).alias("out"),
        combine(s["acc"], x["_e"]).alias("acc")))
    local = grouped.select("_b", "_c", folded.alias("_f")).select("_b", "_c", "_f.out", "_f.acc")
    if rows <= chunk:
        return local.select("_b", F.inline("out")).select("_b", F.col("i").alias("_i"), F.col("v").alias("_before"))
    local = materialize(local, "chunk")
    # A block that goes on beyond its chunk touches an edge of it; the others, such as many short blocks, are done.
    edge = (F.col("out")[0]["i"] == (F.col("_c") - 1) * chunk + 1) | (F.element_at("out", -1)["i"] == F.col("_c") * chunk)
    totals = local.filter(edge).select("_b", F.col("_c").alias("_idx"), F.col("acc").alias("_e"))
    carried = _scan(totals, -(-rows // chunk), combine, identity, chunk).select(
        F.col("_b").alias("_b2"), F.col("_i").alias("_c2"), F.col("_before").alias("_carry"))
    joined = local.join(carried, local["_b"].eqNullSafe(carried["_b2"]) & (local["_c"] == carried["_c2"]), "left")
    carry = F.when(F.col("_c2").isNull(), identity).otherwise(F.col("_carry")).alias("_carry")
    return joined.select("_b", carry, F.inline("out")).select(
        "_b", F.col("i").alias("_i"), combine(F.col("_carry"), F.col("v")).alias("_before"))


def carry_down(df: DataFrame, block: str, order: Sequence[str], value: Column, out: str,
               chunk: int = CHUNK) -> DataFrame:
    """Latest non-null ``value`` at or above each row of its block."""
    tagged = df.withColumn("_v", value)
    kind = tagged.schema["_v"].dataType
    scanned = segmented_scan(tagged, block, order, F.col("_v"), lambda a, b: F.coalesce(b, a),
                             F.lit(None).cast(kind), "_before", chunk)
    return scanned.withColumn(out, F.coalesce("_v", "_before")).drop("_v", "_before")


def last_at_or_above(df: DataFrame, block: str, order: Sequence[str], values: Mapping[str, Column], number: str = "_at") -> DataFrame:
    """Add, for each of ``values``, ``(at, value)`` of the latest row at or above with a non-null value in the block.

    ``at`` numbers the rows in the order of the block and ``order``, as column ``number``.  The rows are placed
    once; a window runs over each block's share of a range partition, so a hot block is as many tasks as it has
    partitions, and what earlier partitions hand on is one row a partition.
    """
    placed = materialize(place_rows(df, [block, *order]), "rownum")
    offsets = place_offsets(placed)
    at = (F.col("_off") + F.col("_pos") + 1).cast("long")
    rows = placed.join(F.broadcast(offsets), "_pid").withColumn(number, at).drop("_off", "_pos")
    found = {n: F.when(v.isNotNull(), F.struct(F.col(number).alias("at"), v.alias("value"), F.col(block).alias("block"))) for n, v in values.items()}
    # The last such row of each partition: found by its number, then read.
    last = rows.groupBy("_pid").agg(*[F.max(F.when(v.isNotNull(), F.col(number))).alias(n) for n, v in values.items()])
    ends = rows.join(F.broadcast(last.select(F.explode(F.array_distinct(F.array_compact(F.array(*values)))).alias(number))), number)
    ends = ends.groupBy("_pid").agg(*[F.max_by(f, f["at"]).alias(n) for n, f in found.items()])
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    handed = materialize(offsets.join(ends, "_pid", "left").select(
        "_pid", *[F.last(n, ignorenulls=True).over(earlier).alias(f"_{n}") for n in values]), "handed")
    above = Window.partitionBy("_pid", block).orderBy(number).rowsBetween(Window.unboundedPreceding, 0)
    kept = [c for c in dict.fromkeys([*df.columns, number]) if c not in values]
    seen = rows.select(*rows.columns, *[F.last(f, ignorenulls=True).over(above).alias(f"_here_{n}") for n, f in found.items()])
    return seen.join(F.broadcast(handed), "_pid").select(*kept, *[
        F.coalesce(f"_here_{n}", F.when(F.col(f"_{n}.block").eqNullSafe(F.col(block)), F.col(f"_{n}"))).dropFields("block").alias(n) for n in values])


def heading_scope(elements: DataFrame, page: str, position: str | Sequence[str], level: str, label: str,
                  ignored: tuple[str, ...] = (), number: str | None = None) -> DataFrame:
    """Attach to each element the section and operation heading it stands under.

    Level-3 headings open a section and close the current operation; level-4
    headings open an operation unless their label is in ``ignored``.  An element
    before any operation heading keeps a null ``operation`` (unassigned).
    ``position`` is one column or several; ``number`` names a column for the
    elements' numbers 1..n in the order of page and position.
    """
    is_section = F.coalesce(F.col(level) == 3, F.lit(False))
    is_operation = F.coalesce(F.col(level) == 4, F.lit(False)) & ~F.col(label).isin(*ignored)
    # A section without a label closes what is above, too; an operation without one opens nothing.
    marks = {"_section": F.when(is_section, F.struct(F.col(label).alias("label"))), "_operation": F.when(is_operation, F.col(label))}
    scanned = last_at_or_above(elements, page, [position] if isinstance(position, str) else list(position), marks, number or "_at")
    inside = F.col("_section").isNull() | (F.col("_operation.at") > F.col("_section.at"))
    out = scanned.withColumn("section", F.col("_section.value.label")).withColumn("operation", F.when(inside, F.col("_operation.value")))
    return out.drop("_section", "_operation", *([] if number else ["_at"]))
