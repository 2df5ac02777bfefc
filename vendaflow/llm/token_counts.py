"""Token counts kept in a cache keyed by content digest and tokenizer version."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaflow.llm.tokens import encode, file_digest
from vendaflow.session import materialize

CACHE_SCHEMA = "digest string, n_tokens long"
#: Missing digests up to which they are broadcast to the texts (64 characters each, so some 10 MB).
FEW = 100_000


def _stored(spark, path: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per digest, whatever runs wrote it; none if nothing has been stored yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], CACHE_SCHEMA)
    runs = spark.read.schema(CACHE_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    return runs.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counter(tokenizer: str):
    def run(batches):
        for batch in batches:
            counts = [len(encode(t, tokenizer)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """Tokens of every whole text, encoding each distinct text that `cache` does not hold, once.

    Content is normalised as the vocabulary's own file asks (it has no normaliser): null becomes the empty text,
    nothing else changes, so that a stored count is the count of the text itself. Digests are SHA-256. The digests of the rows,
    without texts, are joined to the stored ones first. Texts are fetched for misses only: below `FEW` missing digests their
    broadcast leaves other texts where they are; with more, texts are grouped by digest, with a combine before the shuffle, so a
    text with very many copies crosses it a few times only. With none missing no text is read again.

    `cache` holds a folder per tokenizer version (the digest of its file) and in it one per run, written once: several runs may
    append at a time, a run that dies leaves nothing that others count on, and a digest that two runs stored counts once. Rows
    with null ids, repeated rows and empty texts are counted like any other; other columns are ignored. Returns id, n_bytes,
    n_tokens, over_limit."""
    spark = docs.sparkSession
    store = f"{cache.rstrip('/')}/{file_digest(tokenizer)}"
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.sha2("text", 256))
    light = materialize(rows.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "resumos")
    missing = materialize(light.select("digest").distinct().join(_stored(spark, store), "digest", "left_anti"), "faltam")
    n = missing.count()
    if n:
        texts = rows.select("digest", "text")
        if n <= FEW:
            texts = texts.join(F.broadcast(missing), "digest", "left_semi")
        texts = texts.groupBy("digest").agg(F.first("text").alias("text"))
        if n > FEW:
            # an inner join, as a semi join would be moved below the grouping, before its combine
            texts = texts.join(missing, "digest").select("digest", "text")
        texts.mapInArrow(_counter(tokenizer), CACHE_SCHEMA).write.parquet(f"{store}/{uuid.uuid4().hex}")
    counts = _stored(spark, store)
    return light.join(counts, "digest").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
