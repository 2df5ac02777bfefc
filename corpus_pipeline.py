"""Training corpus pipeline: toxicity, near-duplicates, benchmark leaks, personal data, packing.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a DataFrame; all but the last return the
columns of `documents`. `run` writes each stage's result and reads it again for the next. No stage drops rows for other
reasons than its own decision, which is made for each row: a null or shared id neither saves a row nor condemns another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaflow.llm.decontamination import find_benchmark_words
from vendaflow.llm.near_duplicates import near_duplicates
from vendaflow.llm.packing import pack
from vendaflow.llm.pii import fit_pii, redact
from vendaflow.llm.queries import prepare, table, training_labels
from vendaflow.llm.tokens import tokenizer_path
from vendaflow.llm.toxicity import fit_toxicity, score_toxicity
from vendaflow.session import materialize

#: Similarity in percent from which the near-duplicate stage links; the limit of `op9_near_duplicates`.
PERCENT = 85


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = fit_toxicity(docs, training_labels(spark, sf_dir))
    # columns of any name, also those of the score, pass through under numbers
    numbered = [f"c{i}" for i in range(len(docs.columns))]
    scored = score_toxicity(docs.toDF(*numbered), model, numbered[docs.columns.index("text")], tuple(numbered))
    return scored.where("predicted = 0").select(*numbered).toDF(*docs.columns)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, in a column that `docs` does not have, written once so that every reader sees the same numbers.
    The number carries decisions that belong to the row and not to its id."""
    name = "__row"
    while name in docs.columns:
        name += "_"
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "linhas"), name


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id, a null id last; of repeated rows one."""
    prepare(spark)
    rows, row = _numbered(docs)
    groups = materialize(near_duplicates(rows, PERCENT, row).select(row, "component_id"), "copias")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", row)).alias("first")
    chosen = materialize(groups.join(rows.select(row, "doc_id").hint("merge"), row).groupBy("component_id").agg(first).select(F.col(f"first.{row}").alias(row)), "escolhidas")
    # they grow with the corpus: never a broadcast, the same plan at every size
    return rows.join(chosen.hint("merge"), row, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any passage of a benchmark item."""
    rows, row = _numbered(docs)
    found = find_benchmark_words(rows, table(spark, sf_dir, "benchmark"), row)
    leaked = materialize(found.where("contaminated").select(row), "vazados")
    return rows.join(leaked, row, "left_anti").select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by its kind, and their new lengths where there is a column for them."""
    prepare(spark)
    clean = redact(docs, fit_pii(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    prepare(spark)
    return pack(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicate), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]

#: Learned models and tokens cannot be stated in SQL; the tests compare `run` with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
