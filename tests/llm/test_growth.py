"""Results and sizes of intermediate tables where many rows share one thing, and models on planted data."""

import random

import brute
import numpy as np

from vendaflow.llm import decontamination
from vendaflow.llm.queries import prepare
from vendaflow.llm.secrets import ALPHABETS, find_secrets
from vendaflow.llm.toxicity import label_model


def test_template_shared_by_items_and_documents(spark, monkeypatch):
    prepare(spark)
    sizes, real = {}, decontamination.materialize

    def counted(df, name):
        out = real(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(decontamination, "materialize", counted)
    template = " ".join(f"t{i}" for i in range(11))
    items = [(i, f"{template} item {i} own words only here") for i in range(400)] + [(1000 + i, "hello") for i in range(40)]
    docs = [(i, f"before {i} {template} after {i}" + (" hello" if i % 7 == 0 else "")) for i in range(400)] + [(900, "nothing here"), (901, None)]
    found = {r["doc_id"]: r for r in decontamination.find_benchmark_words(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, (n_words, n_hit, ids) in brute.contaminated(docs, items).items():
        r = found[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n_words, n_hit, len(ids), brute.sha(",".join(ids))), i
    # two windows per document, and one for each "hello"
    assert sizes["candidatos"] <= 2 * 400 + 58 and sizes["ocorrencias"] <= sizes["candidatos"]


def test_random_strings_of_every_alphabet_and_long_identifiers(spark, documents):
    prepare(spark)
    rnd = random.Random(11)
    forms = {"snake": "_".join, "constant": lambda w: "_".join(w).upper(), "kebab": "-".join, "path": "/".join, "joined": "".join,
             "camel": lambda w: w[0] + "".join(x.capitalize() for x in w[1:])}
    plain = ("mountain yellow kitchen orchestra gentle harvest winter pocket bridge teacher silver village morning garden doctor "
             "thunder planet shadow bicycle lantern").split()
    kinds = [(k, "".join(rnd.choice(letters) for _ in range(32))) for k, letters in ALPHABETS.items() for _ in range(100)]
    kinds += [(k, join([rnd.choice(plain) for _ in range(5)])) for k, join in forms.items() for _ in range(100)]
    rows = documents + [(10**9 + i, f"see {value} here") for i, (_, value) in enumerate(kinds)]
    found = {r["doc_id"]: r for r in find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    marked = {}
    for i, (kind, value) in enumerate(kinds):
        spans = found[10**9 + i]["spans"]
        assert spans in ("", f"hex:4:{4 + len(value)}", f"random:4:{4 + len(value)}")
        marked.setdefault(kind, []).append(spans != "")
    assert all(np.mean(marked[k]) >= 0.95 for k in ALPHABETS), marked
    assert np.mean([m for k in forms for m in marked[k]]) <= 0.01


def planted(n=6000, seed=3):
    rng = np.random.default_rng(seed)
    truth = rng.random(n) < 0.3
    rates = np.array([[0.7, 0.5, 0.3, 0.6], [0.05, 0.1, 0.02, 0.2]])
    votes = rng.random((n, 4)) < rates[1 - truth.astype(int)]
    return truth, rates, votes, (truth ^ (rng.random(n) < 0.1)).astype(float)


def test_label_model_recovers_accuracies():
    truth, rates, votes, given = planted()
    model = label_model(votes, given)
    assert np.abs(model.rates[:, :4] - rates).max() < 0.04 and np.abs(model.rates[:, 4] - [0.9, 0.1]).max() < 0.04
    assert (model.parent == -1).all()
    assert np.mean((model.posterior >= 0.5) == truth) > np.mean((given > 0) == truth) + 0.03


def test_voters_that_repeat_another_add_no_evidence():
    truth, _, votes, given = planted()
    repeated = np.concatenate([votes, *[votes[:, [3]]] * 8], 1)
    once, often = label_model(votes, given), label_model(repeated, given)
    assert np.abs(once.posterior - often.posterior).max() < 0.03
    # the copies and their model form one tree; the others stay alone
    assert (often.parent[:3] == -1).all() and sorted(often.parent[3:])[0] == -1 and (np.sort(often.parent[3:])[1:] >= 3).all()


def test_label_model_on_edges():
    for n, label in ((1, 1.0), (3, 0.0)):
        model = label_model(np.zeros((n, 4), bool), np.full(n, label))
        assert np.isfinite(model.posterior).all() and model.posterior.shape == (n,)
