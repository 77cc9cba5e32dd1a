"""Contiguous shards of near-equal bytes, from global prefix sums over per-partition totals.

Ids, sizes and checksums are laid out once in ranges of the order; the ranges' totals, one row a range, give each
range its start, and a row's global position is that start plus its running sum inside the range. Texts are
neither sorted nor shuffled. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settled

SHARDS = 40
ROW_BYTES = 16


def sized(docs: DataFrame, row_bytes: int = ROW_BYTES) -> DataFrame:
    """(doc_id, size, text_crc32): UTF-8 bytes plus `row_bytes`; a null text has no bytes and the checksum of none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with `_before` (size of all rows before), `_index` (their number), `_total`."""
    ranged = settled(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy("_range").agg(F.sum("size").alias("_size"), F.count(F.lit(1)).alias("_rows"))
    # One row for each range, as many as the session has shuffle partitions.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "_range",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_size_start"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_row_start"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    running = ranged.select(
        "*",
        (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("_size_in"),
        (F.row_number().over(inside) - 1).alias("_row_in"),
    )
    placed = running.join(F.broadcast(starts), "_range")
    return placed.withColumns({"_before": F.col("_size_start") + F.col("_size_in"), "_index": F.col("_row_start") + F.col("_row_in")}).drop(
        "_range", "_size_start", "_size_in", "_row_start", "_row_in"
    )


def _shard(shards: int) -> Column:
    """The equal target that the middle of a row's bytes falls into."""
    middle = (F.col("_before") * 2 + F.col("size")).cast("decimal(38,0)")
    share = F.floor(middle * shards / (F.col("_total").cast("decimal(38,0)") * 2)).cast("int")
    return F.when(F.col("_total") > 0, F.least(share, F.lit(shards - 1))).otherwise(0)


def byte_shards(docs: DataFrame, shards: int = SHARDS, row_bytes: int = ROW_BYTES) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of `docs` (doc_id, text).

    Rows stand in the order of doc_id (nulls first), then checksum and size; rows equal in all three are
    interchangeable. Shards are contiguous in that order and differ from the equal target by less than the
    largest row on either side; a row larger than two targets can leave a shard empty. slot counts a shard's
    rows from 0. Equal texts count like any others. An empty table gives an empty table; other columns are
    ignored.
    """
    placed = _placed(sized(docs, row_bytes), ["doc_id", "text_crc32", "size"]).withColumn("shard", _shard(shards))
    placed = settled(placed.select("doc_id", "size", "text_crc32", "shard", "_index"))
    firsts = placed.groupBy("shard").agg(F.min("_index").alias("_first"))
    out = placed.join(F.broadcast(firsts), "shard")
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("_index") - F.col("_first")).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, row_bytes: int = ROW_BYTES) -> None:
    """Write the rows of `docs` below `path`, one folder shard=N each, in the order of their slots.

    A shard is a range of (doc_id, checksum, size), so rows find theirs by the first row of each shard, which
    are at most `shards` rows; rows that tie with a first row go to the later shard.
    """
    placed = byte_shards(docs, shards, row_bytes)
    key = ["doc_id", "text_crc32", "size"]
    firsts = sorted((r["shard"], *(r[k] for k in key)) for r in placed.where("slot = 0").collect())
    text = F.coalesce(F.col("text"), F.lit(""))
    own = F.struct(F.col("doc_id").cast("long"), F.crc32(text.cast("binary")), (F.octet_length(text) + F.lit(row_bytes)).cast("long"))
    shard = F.lit(firsts[0][0] if firsts else 0)
    # Later shards are asked first.
    for number, doc_id, crc, size in firsts[1:]:
        first = F.struct(F.lit(doc_id).cast("long"), F.lit(crc).cast("long"), F.lit(size).cast("long"))
        shard = F.when(F.col("_own") >= first, number).otherwise(shard)
    rows = docs.withColumn("_own", own).withColumn("shard", shard)
    rows.repartitionByRange("shard", "_own").sortWithinPartitions("shard", "_own").drop("_own").write.partitionBy("shard").parquet(path)
