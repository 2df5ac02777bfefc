"""Hard negatives, source divergence and language-model scores against plain versions."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import SF
from pyspark.sql import functions as F

from vendaflow.llm import hard_negatives as hn
from vendaflow.llm import lm_scoring as lm
from vendaflow.llm import queries
from vendaflow.llm import source_divergence as sd
from vendaflow.llm.hard_negatives import hard_negatives
from vendaflow.llm.lm_scoring import language_model_scores
from vendaflow.llm.source_divergence import source_divergence


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_source_divergence"])
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.REGISTRY[name].oracle)
    columns = [x[0] for x in want.description]
    got = queries.REGISTRY[name].run(spark, SF)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


# hard negatives


def mined(rows, positives=5, negatives=10, every=100):
    """Plain version over (id, label, whole-number vector)."""
    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for i, label, v in rows:
        if i % every:
            continue
        others = sorted(((-score(v, w), j, k) for j, k, w in rows if (j, k, w) != (i, label, v)), key=lambda x: x[:2])
        for s, j, _ in [o for o in others if o[2] == label][:positives]:
            inside = [o for o in others if o[2] != label and 30 * -s <= 100 * -o[0] <= 90 * -s]
            out += [(i, j, r + 1, o[1], -s, -o[0]) for r, o in enumerate(inside[:negatives])]
    return sorted(out)


def clustered(n, seed, dim=12, groups=40):
    """Vectors around some centres, every fifth a copy of one hot vector: ties, hot cells, windows with and without rows."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    out = []
    for i in range(n):
        v = centres[0] if i % 5 == 0 else centres[rng.integers(groups)] + rng.normal(size=dim) * 0.2
        out.append((i, int(rng.integers(4)), [float(x) for x in v]))
    return out


def test_hard_negatives_on_clusters(spark, monkeypatch):
    monkeypatch.setattr(hn, "CELL", 8)
    monkeypatch.setattr(hn, "PART", 64)
    monkeypatch.setattr(hn, "VISITORS", 7)
    monkeypatch.setattr(hn, "FIRST", 40)
    rows = clustered(1200, 3)
    got = hard_negatives(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), anchor_every=25)
    want = mined([(i, k, tuple(math.floor(256 * x) for x in v)) for i, k, v in rows], every=25)
    assert sorted(map(tuple, got.collect())) == want


def test_walk_is_ordered_and_its_bounds_hold(monkeypatch):
    monkeypatch.setattr(hn, "FIRST", 100)
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(900, 8)))
    grid = hn.Grid(hn._codebook(x[:, :4], 12, rng), hn._codebook(x[:, 4:], 12, rng))
    (i, d1), (j, d2) = hn._nearest(x[:, :4], grid.first), hn._nearest(x[:, 4:], grid.second)
    cell = i * 12 + j
    grid.rows = np.bincount(cell, minlength=144)
    grid.radius = tuple(np.array([d[c == k].max(initial=0) for k in range(12)]) for c, d in ((i, d1), (j, d2)))
    for q in x[:20]:
        walk = list(grid.walk(q))
        bounds = [b for b, _ in walk]
        assert bounds == sorted(bounds, reverse=True)
        assert sorted(c for _, c in walk) == list(np.flatnonzero(grid.rows))
        assert all((x[cell == c] @ q).max() <= b for b, c in walk)
        first, rest = grid.visits(q, -np.inf, np.inf, None), grid.visits(q, -np.inf, np.inf, bounds[60])
        assert not set(first) & set(rest) and len(first) < len(walk)
        assert {c for b, c in walk if b >= bounds[60]} <= set(first) | set(rest)


def test_hard_negatives_on_edges(spark):
    schema = "label int, vec_id long, embedding array<double>, row string, score string, cell string, part string"
    inf, nan = float("inf"), float("nan")
    rows = [(1, 100, [1.0, 0.5]), (1, 100, [1.0, 0.5]), (1, 3, [1.0, 0.5]), (1, 4, [1.0, 0.5]), (2, 5, [0.5, 0.25]), (2, 6, [0.5, 0.25]), (2, 9, [0.5]), (None, 7, [1.0, 1.0]),
            (1, None, [1.0, 1.0]), (2, 8, None), (2, 10, [None, 1.0]), (2, 11, [nan, 1.0]), (2, 12, [inf, 1.0]), (3, 200, [0.0, 0.0]), (3, 13, [0.0, 0.0]), (4, 300, []), (5, 400, [1.0, 2.0])]
    frame = spark.createDataFrame([(k, i, v, "x", "x", "x", "x") for k, i, v in rows], schema)
    whole = {(i, k, tuple(math.floor(256 * x) for x in v + [0.0] * (2 - len(v)))) for k, i, v in rows
             if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    assert sorted(map(tuple, hard_negatives(frame).collect())) == mined(sorted(whole))
    assert hard_negatives(frame.limit(0)).collect() == []
    assert hard_negatives(frame.where("vec_id = 12")).collect() == []
    assert hard_negatives(frame.where("vec_id = 100")).collect() == []
    # beyond the whole numbers of doubles, and beyond a long
    big = [(1, 0, [2.0**22 + 1, 3.0]), (1, 1, [2.0**22, 1.0]), (2, 2, [2.0**21 + 1, 5.0]), (2, 3, [1e300, 1.0]), (2, 4, [1.7e308, 0.0])]
    got = hard_negatives(spark.createDataFrame(big, "label int, vec_id long, embedding array<double>"))
    q = [tuple(math.floor(256 * x) for x in v) for _, _, v in big[:3]]
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 2, sum(a * b for a, b in zip(q[0], q[1])), sum(a * b for a, b in zip(q[0], q[2])))]


# source divergence


def diverged(rows, least=30, top=50):
    docs = [(lang or "", source or "", [t.lower() if t.isascii() else "".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in
             re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, source, text in rows]
    df, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in docs:
        df[lang].update(set(terms))
        n[lang].update(terms)
        n[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t in df[lang] if df[lang][t] >= least]

        def share(key, t):
            return 1 + 1_000_000_000 * (n[key][t] + 5) // (sum(n[key][k] for k in kept) + 5 * len(kept))

        p = {s: [share((lang, s), t) for t in kept] for s in sources}
        q = [share(lang, t) for t in kept]
        for s in sources:
            pairs = [(-sum(abs(x - y) for x, y in zip(p[s], p[o])), o) for o in sources - {s}]
            terms = [(y - x, t) for x, y, t in zip(p[s], q, kept) if n[lang, s][t] and x > y]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, item, -v, r + 1) for r, (v, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode()))[:limit])]
    return sorted(out)


def test_source_divergence_on_ties_and_edges(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK", 40)
    monkeypatch.setattr(sd, "DENSE", 30)
    monkeypatch.setattr(sd, "HELD", 50)
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqr"] + ["é", "日本", "Z", "ſ", "\U00010348x", "ÉTÉ"]
    rows = [(str(rng.choice(["en", "fr"])), str(rng.choice(["s1", "s2", "S3", "é"])), " 1-".join(rng.choice(words, 12))) for _ in range(120)]
    # one source says every word exactly once: a cell of equal values larger than the list
    rows += [("en", "all", " ".join(words))] * 2 + [(None, None, None), ("en", "silent", "123 !"), ("en", "silent", ""), ("xx", "one", "alone"), ("yy", "a", ""), ("yy", "b", "few words")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int")
    for top in (50, 7):
        assert sorted(map(tuple, source_divergence(frame, 12, top).collect())) == diverged(rows, 12, top)
    assert source_divergence(frame.limit(0)).collect() == []
    assert len(source_divergence(frame.where("lang is null")).collect()) == 0


# language model


def scored(rows, held, least=2):
    """(n_tokens, n_known, N, base, score) of each text, with dictionaries."""
    def tokens(text):
        return [*"".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" "), None]

    texts = [[t for t in tokens(text) if t != ""] for _, text in rows]
    one, two = Counter(), Counter()
    for t, h in zip(texts, held):
        if not h:
            one.update(t)
            two.update(zip([0, *t[:-1]], t))
    total, kinds = sum(one.values()), len(one)
    # pairs with a word that is too rare are never counted, nor are they once or twice
    ok = {k: c for k, c in two.items() if (one[k[0]] if k[0] != 0 else one[None]) >= least and one[k[1]] >= least}
    n1, n2 = sum(c == 1 for c in ok.values()), sum(c == 2 for c in ok.values())
    d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    arcs = {k: c for k, c in ok.items() if c >= least}
    mass = defaultdict(float)
    for (a, _), c in arcs.items():
        mass[a] += c - d
    size = lambda a: one[None] if a == 0 else one[a]
    out = []
    for t in texts:
        base = score = 0.0
        for a, b in zip([0, *t[:-1]], t):
            p1 = (one[b] + 1) / (total + kinds + 1)
            base += math.log10(p1)
            back = 1 - mass[a] / size(a) if size(a) else 1
            score += math.log10((arcs[a, b] - d) / size(a) + back * p1 if (a, b) in arcs else back * p1)
        out.append((len(t), sum(one[x] > 0 for x in t), total, base, score))
    return out


def close(got, want):
    return got[:3] == want[:3] and all(math.isclose(g, w, rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got[3:], want[3:]))


FIELDS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def test_language_model(spark, documents):
    found = {r["doc_id"]: r for r in queries.REGISTRY["op13_lm_scoring"].run(spark, SF).collect()}
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in documents]
    assert len(found) == len(documents)
    for (i, _), h, want in zip(documents, held, scored(documents, held)):
        assert found[i]["held_out"] == h and close(tuple(found[i][c] for c in FIELDS), want), i
    # pairs help on texts that the model has not seen
    gain = [found[i]["score"] - found[i]["base_score"] for (i, _), h in zip(documents, held) if h]
    assert sum(gain) > 0


def test_language_model_in_small_shards(spark, documents, monkeypatch):
    """Many shards, many buckets, contexts dealt over pieces, texts cut into stretches and hashed in slices."""
    monkeypatch.setattr(lm, "SHARD", 20_000)
    monkeypatch.setattr(lm, "SLICE", 300)
    monkeypatch.setattr(lm, "ASKED", 5_000)
    monkeypatch.setattr(lm, "HOT", 50)
    monkeypatch.setattr(lm, "TOP", 400)
    monkeypatch.setattr(lm, "STRETCH", 7)
    rows = documents[:200]
    frame = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in language_model_scores(frame, F.col("doc_id") % 3 == 0).collect()}
    for (i, _), want in zip(rows, scored(rows, [i % 3 == 0 for i, _ in rows])):
        assert close(tuple(got[i][c] for c in FIELDS), want), i


def test_language_model_on_edges(spark):
    long = " ".join(f"w{i % 50} v{i % 3}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n\t\x0b"), (4, "A b a B"), (4, "a b a b"), (None, "A b"), (5, long), (6, "é É\u00a0x ſ a"), (7, "x" * 3_000_000), (8, "a b c")]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, shard string, words string")
    order = lambda i: (i is None, i)
    for held in ([False] * len(rows), [i == 8 for i, _ in rows], [True] * len(rows)):
        ids = [i for (i, _), h in zip(rows, held) if h]
        test = F.lit(False) if not ids else F.lit(True) if len(ids) == len(rows) else F.col("doc_id") == 8
        got = sorted(((r["doc_id"], *(r[c] for c in FIELDS)) for r in language_model_scores(frame, test).collect()), key=lambda r: order(r[0]))
        want = sorted(((i, *w) for (i, _), w in zip(rows, scored(rows, held))), key=lambda r: order(r[0]))
        assert all(g[0] == w[0] and close(g[1:], w[1:]) for g, w in zip(got, want)) and len(got) == len(want)
    assert language_model_scores(frame.limit(0), F.lit(False)).collect() == []
    assert language_model_scores(frame, F.lit(None).cast("boolean")).count() == len(rows)


def test_packed_lists_take_the_bytes_that_their_values_need():
    for kind in (np.uint32, np.int64, np.uint64):
        for values in ([], [0], [0, 0, 5], [255, 256], [2**31, 1], [2**32 - 1] * 3):
            found = lm.unpack(lm.pack(np.array(values, kind)), kind)
            assert found.dtype == kind and found.tolist() == values
    assert lm.unpack(lm.pack(np.array([2**64 - 1, 0], np.uint64)), np.uint64).tolist() == [2**64 - 1, 0]
    # rows hold many small counts; eight bytes each in memory, however well they compress, was too much for an executor
    assert len(lm.pack(np.arange(100_000) % 200)) <= 100_001
    assert len(lm.pack(np.arange(60_000, dtype=np.uint32))) <= 120_001


def test_contexts_sum_to_one():
    """Arcs and failure arcs of every state leave a probability of one over all words and one unknown kind."""
    arcs = np.array([0 * 4 + 1, 0 * 4 + 2, 2 * 4 + 0])
    single = np.array([0.4, 0.3, 0.2, 0.1])
    c, context = np.array([3, 2, 4]), np.array([0, 0, 2])
    count, d = np.array([7, 5, 6, 1]), 0.6
    back = 1 - np.bincount(context, c - d, 4) / count
    weight = np.log10((c - d) / count[context] + back[context] * single[[1, 2, 0]])
    model = lm.Automaton(arcs, weight, np.log10(back), np.log10(single), 4)
    for state in range(4):
        _, w = model.step(np.full(4, state), np.arange(4))
        assert math.isclose((10**w).sum(), 1)
