"""Each registered query against a plain version on a small table."""

import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from brute import SF

from vendaflow.llm import queries
from vendaflow.llm.tokens import tokenizer_path


def rows(spark, name, key="doc_id"):
    return {r[key]: r for r in queries.REGISTRY[name].run(spark, SF).collect()}


def test_token_counts(spark, documents):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(tokenizer_path())
    found = rows(spark, "op1_token_counts")
    assert len(found) == len(documents)
    for i, text in documents:
        n = len(exact.encode(text or "", add_special_tokens=False).ids)
        assert (found[i]["n_tokens"], found[i]["n_bytes"], found[i]["over_limit"]) == (n, len((text or "").encode()), n > 1024)


def test_secrets(spark, documents):
    found = rows(spark, "op2_secrets")
    kinds = ["assign", "access", "hex"]
    assert len(found) == len(documents)
    for i, text in documents:
        spans = brute.secrets(text)
        assert [found[i][f"n_{k}"] for k in kinds] == [sum(s[1] == k for s in spans) for k in kinds]
        listed = brute.listed(spans, kinds)
        assert found[i]["base_sha256"] == brute.sha(listed)
        assert set(listed.split(",")) - {""} <= set(found[i]["spans"].split(","))


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(tokenizer_path())
    pieces = queries.op3_packing(spark, SF).collect()
    of, at = defaultdict(list), defaultdict(list)
    for p in pieces:
        of[p["doc_id"]].append(p)
        at[p["sequence_id"]].append((p["offset"], p["length"]))
    total = 0
    for i, text in documents:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        start = 0
        for n, p in enumerate(sorted(of[i], key=lambda p: p["piece"])):
            assert (p["piece"], p["start"]) == (n, start)
            assert p["ids_crc32"] == zlib.crc32(ids[start:start + p["length"]].tobytes())
            assert p["length"] == 2048 or n == 0 and p["length"] < 2048
            start += p["length"]
        assert start == len(ids)
    for placed in at.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(at) <= 1.03 * -(-total // 2048) + 2


def test_near_vectors(spark):
    import pyarrow.parquet as pq

    table = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    found = rows(spark, "op4_near_vectors", "vec_id")
    x = np.array([r["embedding"] for r in table], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([-1 if r["label"] is None else r["label"] for r in table])
    linked = (x @ x.T >= 0.98) & (label[:, None] == label[None, :]) & (label >= 0)[:, None]
    np.fill_diagonal(linked, False)
    have = sum(found[r["vec_id"]]["n_links"] for r in table)
    assert 0.95 * linked.sum() <= have <= linked.sum()
    assert all(found[r["vec_id"]]["n_links"] <= linked[i].sum() for i, r in enumerate(table))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_toxicity_is_learned(spark):
    import pyarrow.parquet as pq

    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    found = rows(spark, "op5_toxicity")
    held = [i for i in found if found[i]["held_out"] and i in labels]
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in found)
    assert np.mean([found[i]["predicted"] == labels[i] for i in held]) >= 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())


def test_repeats(spark, documents):
    found = rows(spark, "op6_repeats")
    for (i, _), want in zip(documents, brute.repeats([t for _, t in documents])):
        assert tuple(found[i][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) == want, i


def test_benchmark_words(spark, documents):
    import pyarrow.parquet as pq

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    found = rows(spark, "op7_decontamination")
    for i, (n_words, n_hit, ids) in brute.contaminated(documents, items).items():
        r = found[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n_words, n_hit, len(ids), n_hit > 0)
        assert r["items_sha256"] == brute.sha(",".join(ids))


def test_pii(spark, documents):
    found = rows(spark, "op8_pii")
    kinds = ["email", "ip", "card", "phone"]
    for i, text in documents:
        spans = brute.personal(text)
        assert [found[i][f"n_{k}"] for k in kinds] == [sum(s[1] == k for s in spans) for k in kinds]
        listed = brute.listed(spans, kinds)
        assert found[i]["base_sha256"] == brute.sha(listed)
        assert set(listed.split(",")) - {""} <= set(found[i]["spans"].split(","))


def test_near_duplicates(spark, documents):
    found = rows(spark, "op9_near_duplicates")
    for i, (n, component) in brute.near_duplicates(documents).items():
        assert (found[i]["n_shingles"], found[i]["component_id"], found[i]["kept"]) == (n, component, component == i)


def test_sharding(spark, documents):
    found = queries.op10_sharding(spark, SF).collect()
    text = dict(documents)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in found:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append((r["slot"], r["doc_id"]))
    assert len(found) == len(documents) and set(sizes) == set(range(40))
    assert all([s for s, _ in sorted(v)] == list(range(len(v))) for v in slots.values())
    order = [i for shard in range(40) for _, i in sorted(slots[shard])]
    assert order == sorted(order)
    assert max(abs(s - sum(sizes.values()) / 40) for s in sizes.values()) <= max(r["size"] for r in found)


@pytest.mark.parametrize("n", [7, 9, 10])
def test_oracle(spark, n):
    import duckdb

    name = next(k for k in queries.REGISTRY if k.startswith(f"op{n}_"))
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = c.execute(queries.REGISTRY[name].oracle)
    columns, by_id = [x[0] for x in want.description], lambda r: r["doc_id"]
    want = sorted((dict(zip(columns, r)) for r in want.fetchall()), key=by_id)
    got = sorted((r.asDict() for r in queries.REGISTRY[name].run(spark, SF).collect()), key=by_id)
    assert got == want
