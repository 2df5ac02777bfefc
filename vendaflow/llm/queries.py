"""Registered queries of the operators, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaflow.llm.decontamination import find_benchmark_words
from vendaflow.llm.embeddings import near_vectors
from vendaflow.llm.hard_negatives import hard_negatives
from vendaflow.llm.lm_scoring import language_model_scores
from vendaflow.llm.near_duplicates import near_duplicates
from vendaflow.llm.packing import pack
from vendaflow.llm.pii import KINDS, find_pii, fit_pii
from vendaflow.llm.repeats import remove_repeats
from vendaflow.llm.secrets import find_secrets
from vendaflow.llm.sharding import ROW_OVERHEAD, shard_by_bytes
from vendaflow.llm.source_divergence import source_divergence
from vendaflow.llm.token_counts import count_tokens
from vendaflow.llm.tokens import tokenizer_path
from vendaflow.llm.toxicity import fit_toxicity, score_toxicity
from vendaflow.session import shared_dir

SHARDS = 40
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def prepare(spark: SparkSession) -> None:
    """Let the Python workers import this library from where the driver did, and bound the bytes of an Arrow batch, which else
    holds 10,000 rows of any length, unless the session has a bound of its own."""
    if spark.conf.get(BATCH_CONF, "1b") == "1b":
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join(filter(None, [root, *paths]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that a toxicity model may learn from: one fifth of the ids is held out."""
    return table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counts live at one place of the shared folder, so that later runs encode new texts only."""
    return count_tokens(table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/vendaflow/token-counts", tokenizer_path())


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit_toxicity(docs, training_labels(spark, sf_dir)))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_benchmark_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_pii(docs, fit_pii(docs))
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def many(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    counts = [many(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_model_scores(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP7 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     windows AS (
       SELECT item_id, least(10, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS gram
       FROM b WHERE len(w) > 0),
     lengths AS (SELECT DISTINCT n FROM windows),
     starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n),
     hits AS (
       SELECT g.doc_id, g.s, g.n, x.item_id
       FROM (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS gram FROM starts) g
       JOIN (SELECT DISTINCT item_id, n, gram FROM windows) x ON x.n = g.n AND x.gram = g.gram),
     covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
     items AS (
       SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.listed, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

# documents of equal sets stand for one another, so that only different sets are compared
_OP9 = r"""
WITH RECURSIVE
     d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
     words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
     grams AS (
       SELECT doc_id, n, pos, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS shingle
       FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
     shingles AS MATERIALIZED (SELECT DISTINCT doc_id, shingle FROM grams WHERE pos <= greatest(n - 4, 1)),
     sets AS (SELECT doc_id, count(*) AS n, sha256(string_agg(shingle, chr(10) ORDER BY shingle)) AS name FROM shingles GROUP BY doc_id),
     named AS MATERIALIZED (
       SELECT doc_id, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY name) END AS rep
       FROM d LEFT JOIN sets USING (doc_id)),
     reps AS MATERIALIZED (SELECT rep, n, shingle FROM named JOIN shingles USING (doc_id) WHERE doc_id = rep),
     common AS (
       SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
       FROM reps a JOIN reps b ON a.shingle = b.shingle AND a.rep < b.rep GROUP BY 1, 2),
     links AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * k >= 85 * (na + nb - k)),
     both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
     reached(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON r.b = e.a),
     lowest AS (SELECT a AS rep, least(a, min(b)) AS component FROM reached GROUP BY a)
SELECT x.doc_id, CAST(x.n AS BIGINT) AS n_shingles, coalesce(l.component, x.rep) AS component_id, x.doc_id = coalesce(l.component, x.rep) AS kept
FROM named x LEFT JOIN lowest l USING (rep)
"""

# the checksum is computed byte by byte; its table of 256 entries follows from the polynomial
_OP10 = f"""
WITH RECURSIVE
     bits(byte, c, step) AS (
       SELECT range, range, 0 FROM range(256)
       UNION ALL
       SELECT byte, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
     crc AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE step = 8),
     sized AS (
       SELECT doc_id, strlen(coalesce(text, '')) + {ROW_OVERHEAD} AS size,
              list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS raw
       FROM documents),
     summed AS (
       SELECT doc_id, size, xor(4294967295, list_reduce(raw, lambda c, x: xor(t[xor(c & 255, x) + 1], c >> 8), 4294967295)) AS text_crc32
       FROM sized, crc),
     placed AS (
       SELECT *, CAST((2 * sum(size) OVER (ORDER BY doc_id) - size) * {SHARDS} // (2 * sum(size) OVER ()) AS INTEGER) AS shard FROM summed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

_OP11 = """
WITH r AS (
       SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
              list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
       FROM embeddings
       WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     scored AS MATERIALIZED (
       SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
       FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
     positives AS (
       SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
       QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

_OP12 = r"""
WITH d AS (
       SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
              regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
       FROM documents),
     words AS MATERIALIZED (SELECT doc, lang, source, unnest(terms) AS term FROM d),
     langs AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
     lang_sums AS (SELECT lang, count(*) AS v, sum(n) AS n FROM langs GROUP BY lang),
     counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN langs USING (lang, term) GROUP BY ALL),
     groups AS (
       SELECT g.lang, g.source, coalesce(c.n, 0) AS n, coalesce(l.v, 0) AS v, coalesce(l.n, 0) AS lang_n
       FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) c USING (lang, source)
       LEFT JOIN lang_sums l USING (lang)),
     shares AS MATERIALIZED (
       SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // (g.n + 5 * g.v) AS p,
              1 + CAST(1000000000 AS HUGEINT) * (t.n + 5) // (g.lang_n + 5 * g.v) AS q
       FROM groups g JOIN langs t ON t.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
     sums AS (
       SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
       FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     found AS (
       SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
       FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
       UNION ALL
       SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
"""


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


REGISTRY = {
    "op1_token_counts": Query(op1_token_counts), "op2_secrets": Query(op2_secrets), "op3_packing": Query(op3_packing),
    "op4_near_vectors": Query(op4_near_vectors), "op5_toxicity": Query(op5_toxicity), "op6_repeats": Query(op6_repeats),
    "op7_decontamination": Query(op7_decontamination, _OP7), "op8_pii": Query(op8_pii),
    "op9_near_duplicates": Query(op9_near_duplicates, _OP9), "op10_sharding": Query(op10_sharding, _OP10),
    "op11_hard_negatives": Query(op11_hard_negatives, _OP11), "op12_source_divergence": Query(op12_source_divergence, _OP12),
    "op13_lm_scoring": Query(op13_lm_scoring), "pipeline": Query(pipeline),
}
