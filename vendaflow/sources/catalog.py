"""Catalog metadata as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def schema_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(tabela, posicao, coluna, tipo, comentario) for frames or saved tables."""
    rows = [(name, i + 1, f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment"))
            for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(
        rows, "tabela string, posicao int, coluna string, tipo string, comentario string")


def database_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {t.name: spark.table(f"{database}.{t.name}") for t in spark.catalog.listTables(database)
            if not t.isTemporary}
