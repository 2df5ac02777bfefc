"""Table sinks: overwrite, partition overwrite, append, comments; row counts observed while writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def commented(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments; they are stored with the table."""
    return df.select([F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
                      for c in df.columns])


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("linhas")), seen


def _clustered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rebalance rows on the partition keys: few files per partition, and adaptive execution splits a partition by its
    measured size when it is too large for one task."""
    return df.hint("rebalance", *keys).select(*[c for c in df.columns if c not in keys], *keys)


def overwrite(df: DataFrame, table: str, comment: str | None = None,
              partition_by: list[str] | None = None) -> int:
    """Full refresh; returns the rows written without a second scan."""
    watched, seen = _counted(_clustered(df, partition_by) if partition_by else df)
    writer = watched.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    if comment:
        text = comment.replace("'", "''")
        df.sparkSession.sql(f"COMMENT ON TABLE {table} IS '{text}'")
    return int(seen.get["linhas"])


def overwrite_partitions(df: DataFrame, table: str, keys: list[str]) -> int:
    """Refresh that replaces only the partitions present in `df`; the table must exist."""
    watched, seen = _counted(_clustered(df, keys))
    watched.select(*df.sparkSession.table(table).columns).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").insertInto(table)
    return int(seen.get["linhas"])


def append_batches(df: DataFrame, table: str, keys: list[str], prefix: str,
                   bucket_by: tuple[str, int] | None = None) -> tuple[list[str], int]:
    """Add rows in new partitions, named by the first key; returns the names, which start with `prefix`, and the rows written.

    With `bucket_by` (column, buckets) each bucket is one sorted file per batch, with a Bloom filter of the column."""
    spark = df.sparkSession
    if bucket_by:
        df = df.repartition(bucket_by[1], bucket_by[0])
    watched, seen = _counted(_clustered(df, keys) if len(keys) > 1 else df.select(*[c for c in df.columns if c not in keys], *keys))
    if spark.catalog.tableExists(table):
        watched.write.insertInto(table)
    else:
        writer = watched.write.format("parquet").partitionBy(*keys)
        if bucket_by:
            column, buckets = bucket_by
            writer = writer.bucketBy(buckets, column).sortBy(column).option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.saveAsTable(table)
    named = {p.split("/")[0].split("=", 1)[1] for (p,) in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    return sorted(n for n in named if n == prefix or n.startswith(f"{prefix}-")), int(seen.get["linhas"])


def append(df: DataFrame, table: str) -> int:
    watched, seen = _counted(df)
    watched.write.mode("append").format("parquet").saveAsTable(table)
    return int(seen.get["linhas"])


def overwrite_path(df: DataFrame, path: str, keys: list[str] | None = None) -> DataFrame:
    """Write Parquet below `path` and return the written frame."""
    writer = df.write.mode("overwrite")
    if keys:
        writer = _clustered(df, keys).write.mode("overwrite").partitionBy(*keys)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def column_comments(spark: SparkSession, table: str) -> dict[str, str]:
    return {c.name: c.description for c in spark.catalog.listColumns(table) if c.description}
