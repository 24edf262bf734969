"""Contiguous shards of nearly equal bytes.

Rows are put in order of their id by range partitions. The total of each partition
gives, summed over the partitions before it, the place in the corpus at which the
partition begins; a running sum inside the partition gives the place of each row.
A row belongs to the shard in whose equal share of all bytes its middle lies. Only
ids, sizes and checksums are moved, never texts.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import partitions, store, text_or_empty

#: Bytes a row takes besides its text.
ROW_BYTES = 16


def byte_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot.

    ``size`` is the UTF-8 length of the text plus 16, a null text has none. Rows
    without an id come last; rows with equal ids are ordered by checksum and size, and
    rows equal in all three are interchangeable. ``slot`` counts from 0 in each shard.
    A text larger than a share leaves shards beside it empty. Other columns of the
    input are not looked at. An empty table gives no rows.
    """
    n = partitions(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_last(), "text_crc32", "size", "row"]
    # Stored, so that the texts are read once and the tie-break stays as it is. ``row``
    # makes the range key unique: rows without an id do not end up in one partition.
    sizes = store(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text_or_empty(text_col)) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(F.encode(text_or_empty(text_col), "UTF-8")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard_sizes",
    )
    placed = store(
        sizes.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "shard_parts"
    )

    # One row per partition, so the windows over them are small at any size.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    running = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cut = store(
        placed.withColumn("bytes_here", F.sum("size").over(running))
        .withColumn("rows_here", F.count("*").over(running))
        .join(F.broadcast(starts), "part")
        .withColumn("middle2", 2 * (F.col("bytes_before") + F.col("bytes_here")) - F.col("size"))
        .select(
            "doc_id", "size", "text_crc32",
            F.expr(f"least({shards - 1}, middle2 * {shards} div (2 * all_bytes))").cast("int").alias("shard"),
            (F.col("rows_before") + F.col("rows_here") - 1).alias("place"),
        ),
        "shard_cuts",
    )
    first = cut.groupBy("shard").agg(F.min("place").alias("first_place"))  # a row per shard
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )
