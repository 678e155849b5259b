"""Sharding by global byte-size prefix sums.

The rows are put in one global order by range partitions. Every partition's
byte total is known first; the running sum of these few totals gives each
partition the bytes that stand before it, so every row gets its global prefix
sum without any task seeing more than its own partition. The sums are cut at
equal targets: shards are contiguous in the order and balanced in bytes.

Only the id, the size and the checksum of a row are moved, never its text. A
hot source or a group of copies does not matter, since the order is by id;
ties are ordered by checksum and size, and rows equal in all three are
interchangeable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def global_prefix(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """``rows`` with ``row_before`` and ``bytes_before`` (rows and summed
    ``size`` that precede the row in the order of the columns ``order``) and
    ``bytes_all``. Empty input gives an empty result."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(rows.repartitionByRange(parts, *order)
                         .withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = placed.groupBy("part").agg(F.count("*").alias("n"), F.sum(size).alias("b"))
    # one row per range partition: at most as many as there are shuffle partitions
    starts = totals.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
        F.sum("b").over(whole).alias("bytes_all"))
    inside = Window.partitionBy("part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (placed.join(F.broadcast(starts), "part")
            .withColumn("row_before", F.col("n0") + F.row_number().over(inside) - 1)
            .withColumn("bytes_before", F.col("b0") + F.coalesce(F.sum(size).over(upto), F.lit(0)))
            .drop("part", "n0", "b0"))


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, size (UTF-8 bytes of the text plus 1; a
    null text has none), text_crc32, law, shard, slot, grown_shard.

    A row goes to the shard that holds its middle byte when all bytes are cut
    into ``shards`` equal parts; ``slot`` counts from 0 inside a shard. A row
    larger than a target can leave shards empty. A null id sorts first.
    Further columns of ``docs`` are not read; an empty table gives no rows."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = global_prefix(rows, ["doc_id", "text_crc32", "size"], "size")
    middle = 2 * F.col("bytes_before") + F.col("size")
    placed = cut_lineage(placed.select(
        "doc_id", "size", "text_crc32", "row_before",
        F.least(F.lit(shards - 1).cast("long"),
                F.floor(middle * shards / (2 * F.col("bytes_all")))).cast("int").alias("shard")))
    first = placed.groupBy("shard").agg(F.min("row_before").alias("row_first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row_before") - F.col("row_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
