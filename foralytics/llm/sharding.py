"""Shards of near equal size by longest-processing-time scheduling.

Rows that must stay together form a group. Groups sorted by falling size go, one
after the other, to the least loaded shard, which a heap gives.

The schedule must not list every group of the corpus in one place. A group that
holds at least 1/``lots`` of all bytes is scheduled as itself (there are ``lots``
of these at most); the other groups are first bundled by the hash of their key
into ``lots`` bundles, each about 1/``lots`` of all bytes, and a bundle is
scheduled like a group. So the heap sees 2 x ``lots`` items at any input size, no
group is ever split, and loads differ by about one bundle, unless one group is
larger than a shard.
"""

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foralytics.llm.common import table
from foralytics.scratch import stage

LOTS = 16_384
# Cells in which slots are numbered: (shard, hash of the row) -> rows in order.
CELLS = 512


def longest_first(sizes: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Item -> shard; larger items first, equal ones by name."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(loads)
        placed[item] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def _schedule(spark: SparkSession, items: DataFrame, shards: int) -> DataFrame:
    """``items`` (item, size): two per lot at most, hence fit for the driver."""
    placed = longest_first([(r["size"], r["item"]) for r in items.collect()], shards)
    return spark.createDataFrame(list(placed.items()), "item string, shard int")


def shard_by_size(rows: DataFrame, group: str, size: str, shards: int, lots: int = LOTS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, which counts the rows of a shard from 0.

    Rows with the same ``group`` are kept together; null is a group like any
    other. ``size`` is a long, null counts as 0. Repeated rows share a group and
    get slots of their own. An empty table gives an empty one. ``rows`` must have no
    columns ``shard``, ``slot``, ``row_cell``, ``in_cell``, ``first_slot``, nor any that begin with two underscores.
    """
    spark = rows.sparkSession
    rows = stage(rows, "shard-rows")
    weight = F.coalesce(F.col(size), F.lit(0))
    total = rows.agg(F.sum(weight)).first()[0] or 0
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64(group), F.lit(lots)).cast("string"))
    own = F.concat(F.lit("group "), F.sha2(F.coalesce(F.col(group).cast("string"), F.lit("null")), 256))
    groups = stage(
        rows.groupBy(F.col(group).alias("__group")).agg(F.sum(weight).alias("__size")), "shard-groups"
    )
    bundle_of_group = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("__group"), F.lit(lots)).cast("string"))
    large = F.col("__size") * lots >= total
    items = groups.groupBy(
        F.when(large, F.concat(F.lit("group "), F.sha2(F.coalesce(F.col("__group").cast("string"), F.lit("null")), 256)))
        .otherwise(bundle_of_group)
        .alias("item")
    ).agg(F.sum("__size").alias("size"))
    placed = _schedule(spark, items, shards).withColumnsRenamed({"item": "__item", "shard": "__shard"})
    # At most two items a lot: a bounded table, like the list of the large groups.
    alone = groups.where(large).select("__group")
    sharded = (
        rows.join(F.broadcast(alone), F.col(group).eqNullSafe(F.col("__group")), "left")
        .withColumn("__item", F.when(F.col("__group").isNull() & F.col(group).isNotNull(), bundle).otherwise(own))
        .join(F.broadcast(placed), "__item")
        .select(*rows.columns, F.col("__shard").alias("shard"))
    )
    return with_slots(sharded, "shard")


def with_slots(rows: DataFrame, shard: str, cells: int = CELLS) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, 2 ... within each ``shard``, without a sort of a whole shard.

    Rows are spread over cells by their hash; the cells of a shard are counted and
    summed up, and rows are numbered only within their cell.
    """
    cell = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(cells))
    spread = stage(rows.withColumn("row_cell", cell), "shard-cells")
    counts = spread.groupBy(shard, "row_cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(shard).orderBy("row_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, "row_cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    order = Window.partitionBy(shard, "row_cell").orderBy(*[F.col(c) for c in rows.columns])
    numbered = spread.withColumn("in_cell", F.row_number().over(order) - 1)
    # shards x cells rows: bounded by two parameters.
    return numbered.join(F.broadcast(starts), [shard, "row_cell"]).select(
        *rows.columns, (F.col("first_slot") + F.col("in_cell")).cast("long").alias("slot")
    )


def op3_sharding(spark: SparkSession, sf_dir: str, shards: int = 8) -> DataFrame:
    """All documents in ``shards`` shards of near equal bytes, equal texts together."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.coalesce(F.octet_length("text").cast("long") + 1, F.lit(1).cast("long")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("text_sha256"),
    )
    placed = shard_by_size(rows, "text_sha256", "size", shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
