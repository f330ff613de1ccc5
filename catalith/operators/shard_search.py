"""Item search over published shards that reads only the shards a page needs.

``publish`` writes the items of a graph in shards of consecutive ids together with two
small tables: rows, mapped rows and record range of each (shard, portal, kind), and
occurrences of each concept in them.  Filters on portal, kind, concept and mode are
answered by those tables alone: running counts over the shards tell which ones hold the
page, and the scan lists just these partitions.  A text or record filter first counts its
matches in the shards that can hold any (one aggregation, no row moves), and then reads the
page's shards in the same way.  So no page, however deep, sorts or numbers the matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from catalith.durable import materialize
from catalith.layout import page_count
from catalith.operators.search import GRAPH_PAGE, check_item_search, item_predicate, semantic_status
from catalith.sinks.export import SHARD_ROWS, shard_concepts, shard_no, shard_stats, shards_for_page


class Shards:
    """A published folder: ``items`` by shard, ``stats`` and ``concepts``; its files are listed once."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType) -> None:
        read = spark.read
        self.path, pair = path, [schema["portal_id"], schema["kind"]]
        self.items = read.schema(StructType([*schema.fields, _SHARD])).parquet(f"{path}/items")
        self.stats = read.schema(StructType([_SHARD, *pair, *_longs("rows", "mapped_rows"), StructField("first_record", StringType()),
                                             StructField("last_record", StringType())])).parquet(f"{path}/stats")
        self.concepts = read.schema(StructType([_SHARD, *pair, StructField("concept_id", StringType()), *_longs("occurrences")])).parquet(f"{path}/concepts")


_SHARD = StructField("shard", IntegerType())


def _longs(*names: str) -> list[StructField]:
    return [StructField(n, LongType()) for n in names]


@dataclass(frozen=True)
class ShardPage:
    """``rows``: one page in id order; ``counts``: matches of every shard that has any; ``shards``: those read for the page."""

    rows: DataFrame
    counts: DataFrame
    shards: tuple[int, ...]
    page_size: int

    def totals(self) -> DataFrame:
        return self.counts.agg(F.coalesce(F.sum("matches"), F.lit(0)).cast("long").alias("total")).select(
            "total", page_count(F.col("total"), self.page_size).alias("pages"))


def publish(items: DataFrame, path: str, rows: int = SHARD_ROWS) -> Shards:
    """Write ``items`` (dense ``id`` from 1, ``concept_ids``) in shards of ``rows`` ids, with their counts."""
    sharded = items.withColumn("shard", shard_no(F.col("id"), rows).cast("int"))
    # By shard and id: a shard is written by one task, or a few where ranges cut it.
    (sharded.repartitionByRange("shard", "id").sortWithinPartitions("shard", "id")
     .write.mode("errorifexists").partitionBy("shard").parquet(f"{path}/items"))
    written = items.sparkSession.read.schema(sharded.schema).parquet(f"{path}/items")
    shard_stats(written).write.parquet(f"{path}/stats")
    shard_concepts(written).write.parquet(f"{path}/concepts")
    return Shards(items.sparkSession, path, items.schema)


def search_shards(
    store: Shards, *, portal: str = "", record: str = "", basis: str = "", q: str = "", concept: str = "",
    mode: str = "mapped", number: int = 1, size: int = GRAPH_PAGE, portals: DataFrame | None = None,
    concepts: DataFrame | None = None, records: DataFrame | None = None,
) -> ShardPage:
    """The page ``search_items`` gives for the same filters, from the published shards."""
    portal, record, basis, q, concept = ((x or "").strip() for x in (portal, record, basis, q, concept))
    check_item_search(portal, record, basis, concept, mode, number, portals, concepts, records)
    wanted = item_predicate(portal, record, basis, q, concept, mode)
    possible = _counts(store, portal, record, basis, concept, mode)
    if q or record:
        found = store.items.join(F.broadcast(possible.select("shard")), "shard", "left_semi").filter(wanted)
        counts = found.groupBy("shard").agg(F.count(F.lit(1)).alias("matches"))
    else:
        counts = possible
    counts = materialize(counts, "shard_counts")
    # A page of ``size`` rows lies in ``size`` shards at most, since every shard listed has a match.
    chosen = shards_for_page(counts, F.col("matches"), number, size).orderBy("shard").collect()
    shards = tuple(r["shard"] for r in chosen)
    rows = store.items.filter(F.col("shard").isin(list(shards)) if shards else F.lit(False)).filter(wanted)
    skip = (number - 1) * size - (chosen[0]["before"] if chosen else 0)
    rows = rows.withColumn("semantic_status", semantic_status()).orderBy("id").offset(max(0, skip)).limit(size)
    return ShardPage(rows.drop("shard"), counts, shards, size)


def _counts(store: Shards, portal: str, record: str, basis: str, concept: str, mode: str) -> DataFrame:
    """Per shard the matches of the counted filters, an upper bound where a record is given; shards without any are absent."""
    n = F.col("occurrences") if concept else F.col("rows") if mode == "all" else F.col("mapped_rows")
    table = store.concepts.filter(F.col("concept_id") == concept) if concept else store.stats
    if portal:
        table = table.filter(F.col("portal_id") == portal)
    if basis:
        table = table.filter(F.col("kind") == basis)
    if record:
        holding = store.stats.filter(F.lit(record).between(F.col("first_record"), F.col("last_record"))).select("shard").distinct()
        table = table.join(holding, "shard", "left_semi")
    return table.groupBy("shard").agg(F.sum(n).cast("long").alias("matches")).filter("matches > 0")
