"""Join assessment, sequence comparison, crosswalks and reference resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.layout import dictionary_join


def assess_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                **alignment: bool | None) -> DataFrame:
    """What a join on these keys would do, without performing it.

    One row: rows and distinct keys per side, rows without a key, cardinality
    class, matched rows, coverage, and the rows the join would produce.  Both
    sides are counted per key first, so a hot key is one row by the time the
    sides meet.  ``alignment`` records externally checked unit/period/space
    flags.  The assessment never permits the join.
    """
    names = [f"k{i}" for i in range(len(left_keys))]

    def per_key(df: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
        return df.groupBy(*[F.col(c).alias(a) for c, a in zip(keys, names, strict=True)]).agg(
            F.count(F.lit(1)).alias(n))

    # Null keys never match in an equi-join; they fall on one side of the outer join.
    both = per_key(left, left_keys, "l").join(per_key(right, right_keys, "r"), names, "full_outer")
    no_key = F.lit(False)
    for c in names:
        no_key = no_key | F.col(c).isNull()
    lk, rk = F.when(~no_key, F.col("l")), F.when(~no_key, F.col("r"))
    hit = lk.isNotNull() & rk.isNotNull()
    s = both.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"), F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.count(lk).alias("left_keys"), F.count(rk).alias("right_keys"),
        F.coalesce(F.sum(F.when(no_key, F.col("l"))), F.lit(0)).alias("left_rows_without_key"),
        F.coalesce(F.sum(F.when(no_key, F.col("r"))), F.lit(0)).alias("right_rows_without_key"),
        F.coalesce(F.max(lk), F.lit(0)).alias("max_left_per_key"), F.coalesce(F.max(rk), F.lit(0)).alias("max_right_per_key"),
        F.count_if(hit).alias("matched_keys"),
        F.coalesce(F.sum(F.when(hit, F.col("l"))), F.lit(0)).alias("matched_left_rows"),
        F.coalesce(F.sum(F.when(hit, F.col("r"))), F.lit(0)).alias("matched_right_rows"),
        F.coalesce(F.sum(F.when(hit, F.col("l") * F.col("r"))), F.lit(0)).alias("joined_rows"))
    many = lambda c: F.when(F.col(c) > 1, F.lit("many")).otherwise(F.lit("one"))
    return s.select(
        "*", F.concat(many("max_left_per_key"), F.lit("_to_"), many("max_right_per_key")).alias("cardinality"),
        F.try_divide(F.col("matched_left_rows").cast("double"), F.col("left_rows")).alias("left_coverage"),
        F.try_divide(F.col("matched_right_rows").cast("double"), F.col("right_rows")).alias("right_coverage"),
        (F.col("joined_rows") - F.greatest("matched_left_rows", "matched_right_rows")).alias("duplicate_expansion"),
        *[F.lit(v).cast("boolean").alias(k) for k, v in sorted(alignment.items())],
        F.lit(False).alias("join_permitted"))


def compare_sequences(left: DataFrame, right: DataFrame, pair: Sequence[str], position: str, value: str) -> DataFrame:
    """Position-wise comparison of two ordered lists per pair.

    One row per pair: lengths, equal and different positions, values only on one
    side, and whether the lists are exactly equal.
    """
    keys = [*pair, position]
    a = left.select(*keys, F.col(value).alias("_l"), F.lit(1).alias("_in_l"))
    b = right.select(*keys, F.col(value).alias("_r"), F.lit(1).alias("_in_r"))
    j = a.join(b, keys, "full_outer")
    same = F.col("_in_l").isNotNull() & F.col("_in_r").isNotNull() & F.col("_l").eqNullSafe(F.col("_r"))
    out = j.groupBy(*pair).agg(
        F.count("_in_l").alias("left_length"), F.count("_in_r").alias("right_length"),
        F.count_if(same).alias("equal_positions"), F.count_if(~same).alias("different_positions"))
    sides = a.select(*pair, F.col("_l").alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        b.select(*pair, F.col("_r").alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    per_value = sides.groupBy(*pair, "v").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    only = per_value.groupBy(*pair).agg(
        F.count_if((F.col("a") == 1) & (F.col("b") == 0)).alias("only_in_left"),
        F.count_if((F.col("a") == 0) & (F.col("b") == 1)).alias("only_in_right"))
    return out.join(only, list(pair)).withColumn("exact_match", F.col("different_positions") == 0)


#: Level of intervals without an end: one bin holds all time.
_OPEN = 63


def crosswalk_join(df: DataFrame, crosswalk: DataFrame, code: str, on_date: str) -> DataFrame:
    """Translate codes with the crosswalk row valid on the row's date.

    ``crosswalk(code, target_code, valid_from, valid_to)``; both ends belong to the interval, an
    open end is null, a row without a start is never valid.  Rows with one valid translation get it
    and the status ``match``; with several ``ambiguous``, with none (or a null code or date) ``unknown``.

    A range join by bins: an interval has the level whose bins are just longer than itself, so it
    lies in two of them at most, and a date is looked up once for every level in use.  Each distinct
    (code, date) is looked up once, however many rows have it.  Of a code's open intervals only the
    two that begin first can tell match from ambiguous, so only these are kept.
    """
    def micros(c: Column) -> Column:
        return F.unix_micros(c.cast("timestamp"))

    rows = crosswalk.select(F.col("code").alias("_code"), F.col("target_code").alias("_target"), micros(F.col("valid_from")).alias("_lo"),
                            micros(F.col("valid_to")).alias("_hi")).filter("_code is not null and _lo is not null and (_hi is null or _hi >= _lo)")
    closed = rows.filter("_hi is not null").withColumn("_level", F.length(F.bin(F.col("_hi") - F.col("_lo") + 1)))
    closed = closed.withColumn("_bin", F.explode(F.expr("array_distinct(array(shiftright(_lo, _level), shiftright(_hi, _level)))")))
    first = Window.partitionBy("_code").orderBy("_lo", "_target")
    endless = rows.filter("_hi is null").withColumn("_n", F.row_number().over(first)).filter("_n <= 2").drop("_n")
    endless = endless.withColumn("_level", F.lit(_OPEN)).withColumn("_bin", F.lit(0).cast("long"))
    book = materialize(closed.unionByName(endless), "crosswalk")
    # At most 64 of them.
    levels = [r["_level"] for r in book.select("_level").distinct().collect()]
    dated = df.withColumn("_code", F.col(code)).withColumn("_day", micros(F.col(on_date)))
    points = dated.select("_code", "_day").dropna().distinct()
    asked = points.withColumn("_level", F.explode(F.lit(levels or [_OPEN]).cast("array<int>")))
    asked = asked.withColumn("_bin", F.expr(f"if(_level = {_OPEN}, 0L, shiftright(_day, _level))"))
    hits = dictionary_join(asked, book, ["_code", "_level", "_bin"]).filter("_day >= _lo and (_hi is null or _day <= _hi)")
    found = materialize(hits.groupBy("_code", "_day").agg(F.count(F.lit(1)).alias("_valid"), F.min("_target").alias("_target")), "translated")
    status = F.when(F.col("_valid") > 1, F.lit("ambiguous")).when(F.col("_valid") == 1, F.lit("match")).otherwise(F.lit("unknown"))
    joined = dictionary_join(dated, found, ["_code", "_day"], "left").withColumn("crosswalk_status", status)
    return joined.withColumn("target_code", F.when(F.col("_valid") == 1, F.col("_target"))).drop("_code", "_day", "_valid", "_target")


def resolve_references(links: DataFrame, records: DataFrame, url: str, pattern: str, portal: str) -> DataFrame:
    """Registrations named by an explicit identifier in a link.

    ``pattern`` has one group, the dataset key.  A key may belong to several
    registrations; they are counted and the first is shown.  Unresolved links
    stay, and no identity is asserted.  Links without a key do not join at all, and a
    key that many links name is spread over several partitions.
    """
    key = F.regexp_extract(url, pattern, 1)
    tagged = links.withColumn("target_key", F.nullif(key, F.lit("")))
    per_key = records.filter(F.col("portal_id") == portal).groupBy(F.col("dataset_key").alias("target_key")).agg(
        F.count(F.lit(1)).alias("target_registrations"), F.min("id").alias("first_target"))
    named = dictionary_join(tagged.filter("target_key is not null"), materialize(per_key, "references"), ["target_key"], "left")
    nameless = tagged.filter("target_key is null")
    for c, kind in per_key.dtypes[1:]:
        nameless = nameless.withColumn(c, F.lit(None).cast(kind))
    return named.unionByName(nameless).withColumn(
        "target_registrations", F.coalesce("target_registrations", F.lit(0)).cast("long")).withColumn(
        "resolved", F.col("target_registrations") > 0).withColumn("same_dataset_asserted", F.lit(False))


def code_list_references(params: DataFrame, code_tables: DataFrame, name: str) -> DataFrame:
    """Bind parameter rows to code tables by name; unresolved ones keep a status."""
    t = code_tables.select(F.col("source_name").alias(name), F.col("id").alias("target_code_table_id"),
                           F.col("evidence_id").alias("target_evidence_id"))
    return dictionary_join(params, t, [name], "left").withColumn(
        "status", F.when(F.col("target_code_table_id").isNotNull(), F.lit("source_reference_observed"))
        .otherwise(F.lit("code_table_unresolved")))


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str]) -> DataFrame:
    """Child rows whose parent does not exist."""
    p = parent.select(*[F.col(b).alias(a) for a, b in zip(keys, parent_keys, strict=True)])
    return child.join(p, list(keys), "left_anti")


def attribute_mismatches(child: DataFrame, parent: DataFrame, keys: Sequence[str], attrs: Sequence[tuple[str, str]]
                         ) -> DataFrame:
    """Child rows whose attributes differ from the parent's; unknown equals unknown."""
    p = parent.select(*keys, *[F.col(b).alias(f"_{b}") for _, b in attrs])
    differs: Column = F.lit(False)
    for a, b in attrs:
        differs = differs | ~F.col(a).eqNullSafe(F.col(f"_{b}"))
    return child.join(p, list(keys)).filter(differs)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], take: Sequence[str]) -> DataFrame:
    """First row of each key in ``order``; reduced before the shuffle."""
    picked = F.min_by(F.struct(*take), F.struct(*order)).alias("_t")
    return df.groupBy(*keys).agg(picked).select(*keys, "_t.*")
