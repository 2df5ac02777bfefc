"""Raw extracts: text-only CSV scans, arrival control and header probe."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaflow.schemas import RAW_TABLES, raw_schema

# Arrival states.
OK, EMPTY, ABSENT = "OK", "VAZIO", "FALTA"


class ArrivalError(Exception):
    """An expected file is missing or has no rows."""


def raw_path(root: str, table: str) -> str:
    system, name, _ = RAW_TABLES[table]
    return f"{root.rstrip('/')}/{system}/{name}"


def read_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Every column as text in the declared order; an empty field is NULL."""
    return spark.read.csv(raw_path(root, table), header=True, schema=raw_schema(table))


def with_source(df: DataFrame, table: str) -> DataFrame:
    """Ingest time and the name of the extract."""
    return df.withColumns({"_ingerido_em": F.current_timestamp(),
                           "_arquivo_origem": F.lit(RAW_TABLES[table][1])})


def _present(spark: SparkSession, path: str) -> bool:
    """Only a missing path counts as absent; any other problem is raised."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


_FILE = r"([^/]+\.csv)(/|$)"


def _sizes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(_f, bytes) of the files, from the listing: no content is read."""
    return (spark.read.format("binaryFile").load(paths).select("path", "length")
            .groupBy(F.regexp_extract("path", _FILE, 1).alias("_f")).agg(F.sum("length").alias("bytes")))


def arrival_listing(spark: SparkSession, root: str, tables: list[str] | None = None) -> DataFrame:
    """One row per expected file: size and whether it is there. Rows are counted when the file is loaded, see `counted`."""
    tables = tables or list(RAW_TABLES)
    expected = spark.createDataFrame([(t, RAW_TABLES[t][0], RAW_TABLES[t][1]) for t in tables], "tabela string, sistema string, arquivo string")
    paths = [p for p in (raw_path(root, t) for t in tables) if _present(spark, p)]
    found = _sizes(spark, paths) if paths else spark.createDataFrame([], "_f string, bytes long")
    return (expected.join(found, F.col("arquivo") == F.col("_f"), "left")
            .select("tabela", "sistema", "arquivo", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.when(F.col("_f").isNull(), ABSENT).otherwise(OK).alias("status"),
                    F.current_timestamp().alias("conferido_em")))


def counted(listing: DataFrame, rows: dict[str, int]) -> DataFrame:
    """The arrival control of files whose data rows were counted while they were loaded (by table)."""
    counts = listing.sparkSession.createDataFrame(list(rows.items()), "tabela string, linhas long")
    return listing.join(counts, "tabela", "left").select(
        "sistema", "arquivo", "bytes", F.coalesce("linhas", F.lit(0)).alias("linhas"),
        F.when(F.col("status") != OK, F.col("status")).when(F.coalesce("linhas", F.lit(0)) == 0, EMPTY).otherwise(OK).alias("status"), "conferido_em")


def arrival_control(spark: SparkSession, root: str, tables: list[str] | None = None) -> DataFrame:
    """One row per expected file: size, data rows, state and check time.

    All present files are counted in one scan; sizes come from the file listing. A path may be one
    file or a folder of part files.
    """
    tables = tables or list(RAW_TABLES)
    expected = spark.createDataFrame(
        [(RAW_TABLES[t][0], RAW_TABLES[t][1]) for t in tables], "sistema string, arquivo string")
    paths = [p for p in (raw_path(root, t) for t in tables) if _present(spark, p)]
    if paths:
        sizes = _sizes(spark, paths)
        one_column = T.StructType([T.StructField("c", T.StringType())])
        rows = (spark.read.csv(paths, header=True, schema=one_column)
                .select(F.regexp_extract("_metadata.file_path", _FILE, 1).alias("_g"))
                .groupBy("_g").agg(F.count("*").alias("linhas")))
        found = sizes.join(rows, sizes["_f"] == rows["_g"], "left")
    else:
        found = spark.createDataFrame([], "_f string, bytes long, linhas long")
    return (expected.join(found, F.col("arquivo") == F.col("_f"), "left")
            .select("sistema", "arquivo", F.coalesce("bytes", F.lit(0)).alias("bytes"),
                    F.coalesce("linhas", F.lit(0)).alias("linhas"),
                    F.when(F.col("_f").isNull(), ABSENT).when(F.coalesce("linhas", F.lit(0)) == 0, EMPTY)
                    .otherwise(OK).alias("status"),
                    F.current_timestamp().alias("conferido_em")))


def require_arrival(control: DataFrame) -> None:
    """Stop when a file is missing or empty. The control has one row per expected file."""
    bad = control.filter(F.col("status") != OK).collect()
    if bad:
        raise ArrivalError("; ".join(f"{r['sistema']}/{r['arquivo']}: {r['status']}" for r in bad))


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of one CSV; reads the header only."""
    return spark.read.csv(path, header=True).columns


def schema_probe(spark: SparkSession, root: str, tables: list[str] | None = None) -> DataFrame:
    """(arquivo, posicao, coluna, esperada) for every header."""
    rows = []
    for t in tables or list(RAW_TABLES):
        declared = RAW_TABLES[t][2]
        for i, c in enumerate(header_columns(spark, raw_path(root, t))):
            rows.append((RAW_TABLES[t][1], i + 1, c, i < len(declared) and declared[i] == c))
    return spark.createDataFrame(rows, "arquivo string, posicao int, coluna string, esperada boolean")
