"""The pipeline as a whole, and its stages on odd tables."""

from collections import defaultdict

import brute
import corpus_pipeline
import pytest
from brute import SF
from pyspark.sql import functions as F

from vendaflow.llm.queries import prepare
from vendaflow.llm.tokens import tokenizer_path

COLUMNS = ["doc_id", "text", "score", "predicted", "__row", "component_id", "contaminated", "held_out"]


@pytest.mark.parametrize("rows", [0, 4])
def test_clashing_columns_no_lengths_and_empty_tables(spark, rows):
    """Columns named like the stages' own pass through every stage unchanged; `n_chars` may be missing; empty tables stay empty."""
    prepare(spark)
    texts = [(1, "one two three four five six", 0.5, "p", 7, "c", "x", "h"), (2, None, None, None, None, None, None, None),
             (None, "", 1.5, "q", 7, "d", "y", "i"), (3, "seven eight nine ten eleven twelve", 0.1, "r", 8, "e", "z", "j")]
    schema = "doc_id long, text string, score double, predicted string, __row long, component_id string, contaminated string, held_out string"
    docs = spark.createDataFrame(texts[:rows], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF)
        assert left.columns == COLUMNS
        assert sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, texts[:rows]))
    placed = corpus_pipeline.packing(spark, docs, SF)
    assert placed.count() == rows


def test_run_keeps_and_packs_what_the_stages_keep(spark):
    """`run` against the stages' decisions: the texts that pass the first four, packed whole and gapless, each token once."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = corpus_pipeline.run(spark, SF).collect()
    kept = {r["doc_id"] for r in pieces}
    clean = {r["doc_id"]: r["text"] for r in corpus_pipeline.toxicity(spark, docs, SF).collect()}
    alone = {i for i, (_, c) in brute.near_duplicates(list(clean.items())).items() if i == c}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {i for i, (_, hit, _) in brute.contaminated([(i, clean[i]) for i in alone], items).items() if hit}
    assert kept == alone - leaks
    left = docs.where(F.col("doc_id").isin(sorted(kept)))
    redacted = {r["doc_id"]: r["text"] for r in corpus_pipeline.pii(spark, left, SF).collect()}
    assert not any(brute.personal(t) for t in redacted.values())
    exact, length, sequences = Tokenizer.from_file(tokenizer_path()), defaultdict(int), defaultdict(list)
    for r in pieces:
        length[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    plain = [i for i in kept if not any(k in (redacted[i] or "") for k in ("[EMAIL]", "[PHONE]", "[CARD]", "[IP]"))]
    assert len(plain) > 100
    for i in plain:
        assert length[i] == len(exact.encode(redacted[i] or "", add_special_tokens=False).ids) + 1
    for placed in sequences.values():
        end = 0
        for offset, n in sorted(placed):
            assert offset == end
            end += n
        assert end <= 2048
