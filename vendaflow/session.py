"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


# Runtime settings the operators rely on: joins carry no salt of their own, so a hot order, SKU,
# customer or rep is split by adaptive execution, also where that costs an extra shuffle.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the skew settings to an existing session."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "vendaflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, skew splitting and UTC dates; `conf` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        **SKEW_SETTINGS,
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder; a temporary one in local mode only."""
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    if current is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vendaflow-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/vendaflow/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "parte") -> DataFrame:
    """Write to the shared folder and read back, so that several consumers (or many passes) share one
    computation and a lost executor re-reads files instead of replaying the plan."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
