"""Intermediate tables that keep their partitioning."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write once into the warehouse, in as many buckets of `key` as a shuffle has partitions, and read back: later joins on
    `key` shuffle the other side only."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(table)
    return spark.table(table)
