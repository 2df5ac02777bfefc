"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaflow.llm.arrow import lists, slices, text_bytes
from vendaflow.llm.hashing import LOWER, Rolling, mix, word_bounds
from vendaflow.session import materialize

#: Labelled rows of each class, chosen by hash, that fit the model; the only thing that is sampled.
FIT_ROWS = 6_000
#: Entries of the learned lexicon, the most frequent among toxic rows first.
LEXICON = 4_096
SUPPORT, ODDS, STRIPES, PREFIXES = 5, 8.0, 8, (4, 5, 6)
_GAP = np.ones(256, bool)
_GAP[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False
_KINDS = 1 + len(PREFIXES)
N_PATTERNS = 6
N_VOTERS = _KINDS * STRIPES + N_PATTERNS
_STEP_BYTES = 1 << 20
#: Likelihood ratio (two degrees of freedom) from which two voters count as dependent; rounds in which dependences are sought.
SIGNIFICANT, SETTLED = 18.4, 20


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, kind (0 word, else a prefix of 4 to 6 bytes) and row of every word feature."""
    low = LOWER[data]
    starts, ends, owner = word_bounds(low, offsets, _GAP)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.int64)
    rolling = Rolling(low)
    parts = [(mix(rolling(starts, ends) + np.uint64(1)), 0, owner)]
    for kind, n in enumerate(PREFIXES, 1):
        long = ends - starts > n
        parts.append((mix(rolling(starts[long], starts[long] + n) + np.uint64(n * 1000)), kind, owner[long]))
    return (np.concatenate([p[0] for p in parts]), np.concatenate([np.full(len(p[0]), p[1], np.int8) for p in parts]),
            np.concatenate([p[2] for p in parts]))


def patterns(data: np.ndarray, offsets: np.ndarray, any_hit: np.ndarray) -> np.ndarray:
    """Votes that do not depend on words: rows x N_PATTERNS, true where the voter speaks."""
    n = np.maximum(np.diff(offsets), 1)

    def share(flag):
        sums = np.concatenate(([0], np.cumsum(flag)))
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / n

    bang = (data == 33) | (data == 63)
    upper = (data >= 65) & (data <= 90)
    twice = np.zeros(len(data), bool)
    twice[1:] = bang[1:] & bang[:-1]
    junk = (data == 35) | (data == 36) | (data == 37) | (data == 38) | (data == 42)
    digit = (data >= 48) & (data <= 57)
    return np.stack([share(bang) > 0.01, share(upper) > 0.3, share(twice) > 0, share(junk) > 0.05, share(digit) > 0.1, ~any_hit], 1)


def lexicon_hits(data: np.ndarray, offsets: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, entry) pairs; `lexicon` is ascending."""
    found, _, row = features(data, offsets)
    if not len(lexicon) or not len(found):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.zeros(1 << 20, bool)
    seen[lexicon >> np.uint64(44)] = True
    maybe = seen[found >> np.uint64(44)]
    found, row = found[maybe], row[maybe]
    at = np.minimum(np.searchsorted(lexicon, found), len(lexicon) - 1)
    exact = lexicon[at] == found
    pair = np.unique(row[exact] * len(lexicon) + at[exact])
    return pair // len(lexicon), pair % len(lexicon)


@dataclass(frozen=True)
class ToxicityModel:
    """Ascending lexicon hashes, their weights, weights of the pattern voters, and the intercept."""
    lexicon: np.ndarray
    weights: np.ndarray
    pattern_weights: np.ndarray
    intercept: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        row, entry = lexicon_hits(data, offsets, self.lexicon)
        margin = self.intercept + np.bincount(row, self.weights[entry], rows) if len(row) else np.full(rows, self.intercept)
        votes = patterns(data, offsets, np.bincount(row, minlength=rows) > 0)
        return 1 / (1 + np.exp(-np.clip(margin + votes @ self.pattern_weights, -30, 30)))


@dataclass(frozen=True)
class LabelModel:
    """Posterior of the true label per row; how often each voter, the given label last, speaks on (toxic, clean) rows; and the
    voter on which each depends within a class (-1: none)."""
    posterior: np.ndarray
    rates: np.ndarray
    parent: np.ndarray


def _dependences(speak: np.ndarray, classes: list[np.ndarray]) -> np.ndarray:
    """Parent of every voter in a heaviest spanning forest over their mutual information within the classes (-1: a root).

    Only pairs whose dependence is significant are joined."""
    n, m = speak.shape
    info = np.zeros((m, m))
    for q in classes:
        total = max(q.sum(), 1e-9)
        both = (speak * q[:, None]).T @ speak / total
        one = np.diag(both)
        for x, y, joint in ((1, 1, both), (1, 0, one[:, None] - both), (0, 1, one[None, :] - both), (0, 0, 1 - one[:, None] - one[None, :] + both)):
            apart = np.where(x, one, 1 - one)[:, None] * np.where(y, one, 1 - one)[None, :]
            joint = np.maximum(joint, 0)
            info += total / n * np.where((joint > 0) & (apart > 0), joint * np.log(np.maximum(joint, 1e-300) / np.maximum(apart, 1e-300)), 0)
    info[2 * n * info < SIGNIFICANT] = 0
    np.fill_diagonal(info, 0)
    parent, left = np.full(m, -1), set(range(m))
    best, source = np.zeros(m), np.full(m, -1)
    while left:
        v = max(sorted(left), key=lambda i: best[i])
        parent[v] = source[v] if best[v] > 0 else -1
        left.remove(v)
        for u in left:
            if info[v, u] > best[u]:
                best[u], source[u] = info[v, u], v
    return parent


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 40) -> LabelModel:
    """Posteriors of the true label from voters that speak or abstain, the given label being one more voter.

    A generative model fitted by EM: given the true label, every voter speaks with a probability that depends on the one voter with
    which it is most strongly correlated within the classes (pairwise factors on a spanning forest). A voter that repeats another
    thus adds no evidence. Accuracies and factors are estimated together; the given label depends on the true one only, and the
    posteriors start from it. The forest is found anew in each of the first `SETTLED` rounds, as
    what noise of the labels made look dependent falls apart while they proceed, then stays."""
    speak = votes.astype(float)
    given = labels.astype(float)
    n, m = speak.shape
    post = np.where(given > 0, 0.95, 0.05)
    parent = np.full(m, -1)
    rates = np.zeros((2, m + 1))
    for turn in range(rounds):
        if turn < SETTLED:
            parent = _dependences(speak, [post, 1 - post])
        told = np.where(parent >= 0, speak[:, parent], 0.0)
        evidence = []
        for k, q in enumerate((post, 1 - post)):
            total = q.sum()
            alone = (q @ speak + 0.5) / (total + 1)
            label = (q @ given + 0.5) / (total + 1)
            rates[k] = np.append(alone, label)
            # where the parent speaks and where it does not, drawn towards the rate over both
            heard = q @ told
            with_parent = (q @ (speak * told) + alone) / (heard + 1)
            without = (q @ (speak * (1 - told)) + alone) / (total - heard + 1)
            p = np.where(told > 0, with_parent, without)
            evidence.append(np.log(np.where(speak > 0, p, 1 - p)).sum(1) + np.log(np.where(given > 0, label, 1 - label)))
        prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
        post = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + evidence[0] - evidence[1], -30, 30)))
    return LabelModel(post, rates, parent)


def _linear(row, entry, size, votes, target, steps: int = 300, ridge: float = 1e-4):
    """Logistic regression on soft labels by full gradient steps with adaptive rates."""
    n = len(target)
    theta = np.zeros(size + votes.shape[1] + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        margin = theta[-1] + votes @ theta[size:-1]
        if len(row):
            margin = margin + np.bincount(row, theta[entry], n)
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target) / n
        grad = np.concatenate([np.bincount(entry, error[row], size) if len(row) else np.zeros(size), error @ votes, [error.sum()]])
        grad[:-1] += ridge * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return theta[:size], theta[size:-1], float(theta[-1])


def _mine(batches):
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        toxic = np.asarray(batch.column(0)).astype(bool)
        kept = []
        for a, b in slices(offsets, _STEP_BYTES):
            found, kind, row = features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            order = np.lexsort((found, row))
            found, kind, row = found[order], kind[order], row[order]
            new = np.ones(len(found), bool)
            new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
            kept.append((found[new], kind[new], toxic[a + row[new]]))
        if not kept:
            continue
        found, kind, hot = (np.concatenate([k[i] for k in kept]) for i in range(3))
        entry, first, back = np.unique(found, return_index=True, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(entry.view(np.int64)), pa.array(kind[first].astype(np.int32)),
             pa.array(np.bincount(back, hot, len(entry)).astype(np.int64)),
             pa.array(np.bincount(back, ~hot, len(entry)).astype(np.int64))], ["feature", "kind", "pos", "neg"])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 fit_rows: int = FIT_ROWS, lexicon_size: int = LEXICON) -> ToxicityModel:
    """Learn voters, label model and classifier from at most `fit_rows` labelled rows of each class, chosen by hash of the id.

    Rows with a null id or label, and ids without a document, are left out; without labelled rows of both classes every text
    scores the share of toxic labels (0 without labels). What reaches the driver is bounded by `fit_rows` and
    `lexicon_size`; the share of toxic labels is taken over all labels."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
             .where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic")))
    share = known.agg(F.avg("toxic").alias("p")).first()["p"]
    empty = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), np.zeros(N_PATTERNS), float(np.log(max(share or 0, 1e-9) / max(1 - (share or 0), 1e-9))))
    if not share or share == 1:
        return empty
    order = [F.xxhash64("id"), F.col("id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(fit_rows).unionAll(
        known.where("toxic = 0").orderBy(*order).limit(fit_rows))
    # bounded by 2 * fit_rows short rows
    sample = materialize(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
                         .join(F.broadcast(chosen), "id").select("toxic", "text"), "amostra")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return empty
    mined = sample.mapInArrow(_mine, "feature long, kind int, pos long, neg long").groupBy("feature", "kind").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = ((F.col("pos") + 0.5) / (sizes[1] + 1)) / ((F.col("neg") + 0.5) / (sizes[0] + 1))
    top = (mined.where((F.col("pos") >= SUPPORT) & (odds >= ODDS)).orderBy(F.desc("pos"), "feature").limit(lexicon_size)
           .select("feature", "kind").collect())
    kinds = {np.uint64(r["feature"] & (2**64 - 1)): (r["kind"], i) for i, r in enumerate(top)}
    lexicon = np.array(sorted(kinds), np.uint64)
    voter = np.array([kinds[f][0] * STRIPES + kinds[f][1] % STRIPES for f in lexicon], np.int64)

    def collect(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in slices(offsets, _STEP_BYTES):
                part, ends = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                row, entry = lexicon_hits(part, ends, lexicon)
                per = np.bincount(row, minlength=b - a)
                spoken = patterns(part, ends, per > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), lists(entry.astype(np.int32), per, pa.int32()),
                     lists(spoken.ravel().astype(np.int8), np.full(b - a, N_PATTERNS), pa.int8())], ["toxic", "entries", "spoken"])

    got = sample.mapInArrow(collect, "toxic int, entries array<int>, spoken array<tinyint>").toPandas()
    target = got["toxic"].to_numpy(dtype=float)
    per = np.array([len(e) for e in got["entries"]], np.int64)
    entry = np.concatenate([np.asarray(e, np.int64) for e in got["entries"]]) if per.sum() else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(per)), per)
    spoken = np.array([list(s) for s in got["spoken"]], float)
    votes = np.zeros((len(target), N_VOTERS), bool)
    votes[row, voter[entry]] = True
    votes[:, _KINDS * STRIPES:] = spoken
    post = label_model(votes, target).posterior
    weights, pattern_weights, intercept = _linear(row, entry, len(lexicon), spoken, post)
    drawn = sizes[1] / (sizes[0] + sizes[1])
    shift = np.log(share / (1 - share)) - np.log(drawn / (1 - drawn))
    return ToxicityModel(lexicon, weights, pattern_weights, intercept + float(shift))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` with score (0 to 1) and predicted (1 from 0.5 on) of every whole text.

    One pass without a shuffle. Null text counts as empty and gets the score of a text without any vote; every row stays."""
    given = docs.select(*keep) if text_col in keep else docs.select(*keep, text_col)
    at = given.columns.index(text_col)

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(pc.fill_null(batch.column(at), ""))
            scores = [model.score(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in slices(offsets, _STEP_BYTES)]
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(keep))], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                [*keep, "score", "predicted"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), "score double", "predicted int"])
    return given.mapInArrow(run, schema)
