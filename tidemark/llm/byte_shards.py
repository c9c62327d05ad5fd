"""Sharding by bytes: global prefix sums from block totals, cut at equal targets.

Documents are put in one global order: by the hash of their text, then by a hash of their
id, then by id. Equal texts are therefore neighbours. The order is cut where the running
sum of bytes passes equal shares of the total, which gives contiguous shards of near equal
size; a shard differs from its share by at most one document and twice ``slack``.

Sums are built in levels, so nothing holds the whole order: rows add up to cells (text
hash and one of ``CELLS`` slices of the ids), cells to blocks (the leading bits of the text
hash, a fixed number of them), and blocks are the only thing summed in one task. A text
that makes up a third of all rows is spread over all its slices.

A group of equal texts stays in one shard if it is at most ``slack`` of a shard; larger
groups are cut where the balance asks for it.

Defined cases: a null text has no bytes (size 1, checksum 0) and groups with empty ones. An
empty table gives an empty result. Repeated rows each get a slot of their own, in either order.
Of a very long text only its size and hashes are moved; one longer than a shard's share makes
that shard so much longer. Other columns are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_of, written

BLOCK_BITS = 12
CELLS = 1024
#: The part of a shard a group of equal texts may have and still be kept together.
SLACK = 0.01


def shards(docs: DataFrame, n_shards: int, slack: float = SLACK) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    rows = written(
        docs.select(
            "doc_id",
            (F.octet_length(text_of()) + 1).cast("long").alias("size"),
            F.crc32(text_of()).alias("text_crc32"),
            F.xxhash64(text_of()).alias("text"),
            F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)).cast("int").alias("cell"),
        ),
        "shard-rows",
    )
    block = F.shiftrightunsigned("text", 64 - BLOCK_BITS).cast("int").alias("block")
    cells = rows.groupBy("text", "cell").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    blocks = rows.groupBy(block).agg(F.sum("size").alias("block_size"), F.count("*").alias("block_n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0)
    starts = blocks.select(
        F.col("block").alias("of_block"),
        F.coalesce(F.sum("block_size").over(before), none).alias("block_start"),
        F.coalesce(F.sum("block_n").over(before), none).alias("block_rank"),
        F.sum("block_size").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("block").orderBy("text", "cell").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("block", "text")
    placed = (
        cells.withColumn("block", block)
        .withColumn("start", F.coalesce(F.sum("size").over(inside), none))
        .withColumn("rank", F.coalesce(F.sum("n").over(inside), none))
        .withColumn("group_size", F.sum("size").over(group))
        .withColumn("group_start", F.min("start").over(group))
        # At most 2 ** BLOCK_BITS rows of 32 bytes: a bound that does not grow with the data.
        .join(F.broadcast(starts), F.col("block") == F.col("of_block"))
        .select(
            F.col("text").alias("of_text"),
            F.col("cell").alias("of_cell"),
            (F.col("block_start") + F.col("start")).alias("cell_start"),
            (F.col("block_rank") + F.col("rank")).alias("cell_rank"),
            (F.col("block_start") + F.col("group_start")).alias("group_start"),
            "group_size",
            "total",
        )
    )
    order = Window.partitionBy("text", "cell").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.when(
        F.col("group_size") * n_shards <= F.col("total") * slack, 2 * F.col("group_start") + F.col("group_size")
    ).otherwise(2 * F.col("start") + F.col("size"))
    shard = F.least(F.floor(middle / (2 * F.col("total")) * n_shards), F.lit(n_shards - 1)).cast("int")
    ranked = written(
        rows.withColumn("before", F.coalesce(F.sum("size").over(order), none))
        .withColumn("nth", F.coalesce(F.count("*").over(order), none))
        .join(placed, (F.col("text") == F.col("of_text")) & (F.col("cell") == F.col("of_cell")))
        .withColumn("start", F.col("cell_start") + F.col("before"))
        .select("doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("cell_rank") + F.col("nth")).alias("rank")),
        "shard-ranks",
    )
    first = ranked.groupBy(F.col("shard").alias("of_shard")).agg(F.min("rank").alias("first"))
    return ranked.join(F.broadcast(first), F.col("shard") == F.col("of_shard")).select(  # n_shards rows
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )
