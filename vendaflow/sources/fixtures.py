"""Fixture files by suffix."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession


def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    """CSV (text columns, header) or JSON (one array or one object per line)."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix == ".csv":
        return spark.read.csv(path, header=True)
    if suffix == ".json":
        return spark.read.json(path, multiLine=_is_array(spark, path))
    raise ValueError(f"unsupported fixture type: {path}")


def _is_array(spark: SparkSession, path: str) -> bool:
    first = spark.read.text(path).filter("length(trim(value)) > 0").first()
    return first is not None and first[0].lstrip().startswith("[")
