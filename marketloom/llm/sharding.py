"""Contiguous shards of near-equal bytes, from global prefix sums.

The rows are dealt into ranges of their key, each range is summed, the sums of the ranges
before it (one row a range) are its offset, and a running sum inside the range gives every
row's place in the whole. Cutting that place at equal targets gives the shards: contiguous
in key order and apart in size by no more than the rows at the cuts. Only the key, the
size and a checksum are shuffled; texts never are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import stored


def byte_shards(rows: DataFrame, key: str, size: str, shards: int, ranges: int = 0) -> DataFrame:
    """rows with `shard` (0 to shards-1) and `slot` (gapless from 0 in each shard).

    rows is materialised once, so that offsets and running sums see the same ranges even if
    executors are lost. Nulls of the key sort first; rows of equal key are ordered by the
    other columns, and rows equal in all are interchangeable. A row belongs to the shard in
    which its middle byte falls; no row gives no shard. Columns named `_range`, `_start` and
    `_rank` are reserved.
    """
    spark = rows.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(key).asc_nulls_first(), *[F.col(c) for c in rows.columns if c != key]]
    dealt = stored(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    totals = dealt.groupBy("_range").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
    # one row for each range: at most `ranges` rows, whatever the input
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows0"),
        F.sum("_bytes").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        dealt.withColumn("_start", F.sum(size).over(inside) - F.col(size))
        .withColumn("_rank", F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1)
        .join(F.broadcast(offsets), "_range")
        .withColumn("_rank", F.col("_rank") + F.col("_rows0"))
        .withColumn("shard", F.expr(f"cast(least({shards - 1}, ((2 * (_start + _bytes0) + {size}) * {shards}) div (2 * _total)) as int)"))
    )
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))  # at most `shards` rows
    return placed.join(F.broadcast(firsts), "shard").select(*rows.columns, "shard", (F.col("_rank") - F.col("_first")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs.

    The size is the text's UTF-8 bytes plus one; a null text counts and sums as an empty
    one. The law is `bytes`, so `grown_shard` is null. Rows are in doc_id order across
    the shards; rows of one doc_id are ordered by size and checksum. Equal texts are
    separate rows. An empty table gives no rows; further columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return byte_shards(rows, "doc_id", "size", shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
