"""Balanced contiguous shards from global prefix sums of byte sizes (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.session import materialize

ROW_OVERHEAD = 16


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut the documents, in order of id, into `shards` contiguous runs of near equal byte size.

    Light rows (id, size, checksum, place in the input, which splits repeated rows) are range-partitioned and written once; each partition's totals give its place in
    the global order, a running sum inside the partition gives every row's, and a row belongs to the shard that holds
    its middle byte. Texts are never shuffled. Only one row per partition and per shard is gathered in one place.

    Null ids come first, null text has no bytes, equal rows are interchangeable; an empty table gives no rows. Other
    columns are ignored. Returns id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    light = docs.select(F.col(id_col).alias("id"), (F.octet_length(text).cast("long") + ROW_OVERHEAD).alias("size"),
                        F.crc32(text.cast("binary")).alias("crc"), F.monotonically_increasing_id().alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["id", "crc", "size", "tie"]
    ranged = materialize(light.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "faixas")
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select("part", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("bytes_before"),
                           F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("rows_before"),
                           F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # one row per partition of the range shuffle: bounded by spark.sql.shuffle.partitions
    placed = (ranged.withColumn("upto", F.sum("size").over(inside)).withColumn("nth", F.count(F.lit(1)).over(inside))
              .join(F.broadcast(places), "part")
              .withColumn("middle", (2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")).cast("decimal(28,0)"))
              .select("id", "size", "crc", (F.col("rows_before") + F.col("nth") - 1).alias("row"),
                      F.expr(f"cast((middle * {shards}) div (2 * all_bytes) as int)").alias("shard")))
    placed = materialize(placed, "colocados")
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
