"""Log-probabilities of texts under a smoothed word model, held as a weighted backoff automaton.

States are words (and the beginning of a text), arcs are pairs of words seen often enough, and every state has a failure arc to the
empty state, whose arcs are the single words. No task holds the model: documents are put into shards of bounded size, shards ask for the
counts of their own words and pairs, buckets of the whole corpus' words and pairs answer, and each shard builds the part of the automaton that its
texts can reach and runs over them from left to right."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from vendaflow.llm.arrow import text_bytes
from vendaflow.llm.hashing import LOWER, SPACE, Rolling, mix, word_bounds
from vendaflow.llm.tables import bucketed
from vendaflow.session import materialize

#: Bytes of text of a shard (a longer text stands alone), bytes that are hashed at once.
SHARD, SLICE = 6 << 20, 1 << 20
#: Requests that one bucket answers, on average.
ASKED = 500_000
#: Occurrences of a context from which its pairs are dealt over several buckets: at least HOT, and no more than TOP contexts' worth.
HOT, TOP = 65_536, 10_000
#: Tokens of a stretch of text; the stretches of a shard's texts are followed side by side.
STRETCH = 512
#: The end of a text as a token, and its beginning as a context; words hash to other values but with a chance of 2 ** -63.
END, BEGIN = np.uint64(0xE0D0FF1E57A7E001), np.uint64(0xBE61B0FF1E57A7E1)
_PIECE = np.uint64(0x9FB21C651E98DF25)


def pack(x: np.ndarray) -> bytes:
    """Values as planes of bytes, the first bytes of all values first, without the last planes that are all zero, behind their number:
    a list of small counts takes a byte a value wherever rows are held, not only where they are compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    many = x.itemsize
    while many > 1 and not planes[many - 1].any():
        many -= 1
    return bytes([many]) + planes[:many].tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
    out[:, :data[0]] = planes.T
    return out.view(kind).ravel()


def _ascending(x: np.ndarray) -> bytes:
    return pack(np.diff(x, prepend=np.uint64(0)))


def _summed(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word; the bytes are cut between words, so that a very long text takes no more memory at once."""
    hashes, owners, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(data):
        to = at + SLICE
        while to < len(data) and not SPACE[data[to - 1]]:
            gap = np.flatnonzero(SPACE[data[to:to + SLICE]])
            to = to + int(gap[0]) + 1 if len(gap) else to + SLICE
        to = min(to, len(data))
        inner = offsets[(offsets > at) & (offsets < to)]
        starts, ends, _ = word_bounds(data[at:to], np.concatenate(([at], inner, [to])) - at, SPACE)
        if len(starts):
            hashes.append(Rolling(LOWER[data[at:to]])(starts, ends))
            owners.append(np.searchsorted(offsets, starts + at, side="right") - 1)
        at = to
    return np.concatenate(hashes), np.concatenate(owners)


class _Shard:
    """Documents gathered until their texts reach the size of a shard."""

    def __init__(self):
        self.ids, self.held, self.sizes, self.tokens, self.bytes = [], [], [], [], 0

    def add(self, ids, held, data, offsets):
        hashes, owner = _word_hashes(data, offsets)
        words = np.bincount(owner, minlength=len(ids))
        ends = np.cumsum(words + 1) - 1
        tokens = np.full(len(hashes) + len(ids), END)
        inside = np.ones(len(tokens), bool)
        inside[ends] = False
        tokens[inside] = hashes
        self.ids.append(ids)
        self.held.append(held)
        self.sizes.append(words + 1)
        self.tokens.append(tokens)
        self.bytes += len(data)

    def row(self, number: int) -> pa.RecordBatch:
        held, sizes, tokens = np.concatenate(self.held), np.concatenate(self.sizes), np.concatenate(self.tokens)
        words, place = np.unique(tokens, return_inverse=True)
        trained = np.bincount(place[np.repeat(~held, sizes)], minlength=len(words))
        ids = pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in self.ids])
        one = [0, len(ids)]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, pa.array(held)),
             *(pa.array([x], pa.binary()) for x in (pack(sizes.astype(np.int64)), pack(place.astype(np.uint32)), _ascending(words), pack(trained.astype(np.int64)))),
             pa.array([len(words)]), pa.array([len(tokens)])],
            ["shard", "ids", "held", "sizes", "tokens", "words", "trained", "n_words", "n_tokens"])


def _gather(batches):
    """One row per shard: ids and sizes of its texts, their tokens as places in the list of its distinct words."""
    shard, number = _Shard(), TaskContext.get().partitionId() << 32
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        held, at = batch.column(1).to_numpy(zero_copy_only=False).astype(bool), 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + max(1, SHARD - shard.bytes), side="right")) - 1
            to = min(batch.num_rows, max(to, at + 1))
            shard.add(batch.column(0).slice(at, to - at), held[at:to], data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
            at = to
            if shard.bytes >= SHARD:
                yield shard.row(number)
                shard, number = _Shard(), number + 1
    if shard.ids:
        yield shard.row(number)


def _dealt(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket (stable), the buckets that occur, and where each begins and the last ends."""
    order = np.argsort(bucket, kind="stable")
    names, starts = np.unique(bucket[order], return_index=True)
    return order, names, np.append(starts, len(bucket))


def _ask_words(buckets: int):
    def run(batches):
        for batch in batches:
            for shard, words, trained in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words, trained = _summed(words), unpack(trained, np.int64)
                order, names, edges = _dealt(words % np.uint64(buckets))
                cut = [order[s:e] for s, e in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.astype(np.int64)), pa.array([shard] * len(names)), pa.array([_ascending(words[c]) for c in cut], pa.binary()),
                     pa.array([pack(trained[c]) for c in cut], pa.binary())], ["bucket", "shard", "words", "trained"])
    return run


_ANSWER = "shard long, bucket long, counts binary, total long, kinds long"


def _answer_words(table: pa.Table) -> pa.Table:
    """Counts over the whole corpus, for each shard in the order in which it asked; and the bucket's totals, as shard -1."""
    asked = [_summed(x) for x in table["words"].to_pylist()]
    known, place = np.unique(np.concatenate(asked), return_inverse=True)
    counts = np.bincount(place, np.concatenate([unpack(x, np.int64) for x in table["trained"].to_pylist()]), len(known)).astype(np.int64)
    edges = np.cumsum([0, *map(len, asked)])
    answers = [pack(counts[place[s:e]]) for s, e in zip(edges, edges[1:])]
    bucket = table["bucket"][0].as_py()
    none = [None] * len(answers)
    return pa.table({"shard": pa.array([*table["shard"].to_pylist(), -1]), "bucket": pa.array([bucket] * (len(answers) + 1)), "counts": pa.array([*answers, None], pa.binary()),
                     "total": pa.array([*none, int(counts.sum())], pa.int64()), "kinds": pa.array([*none, int((counts > 0).sum())], pa.int64())})


class _Texts:
    """A shard's texts with the counts of their words, and their pairs in the order in which buckets are asked."""

    def __init__(self, row: dict, word_buckets: int):
        self.shard, self.ids = row["shard"], row["ids"]
        self.held, self.sizes = np.array(row["held"], bool), unpack(row["sizes"], np.int64)
        self.tokens, self.words = unpack(row["tokens"], np.uint32).astype(np.int64), _summed(row["words"])
        order, names, edges = _dealt(self.words % np.uint64(word_buckets))
        given = {a["bucket"]: a["counts"] for a in row["answers"]}
        self.count = np.zeros(len(self.words), np.int64)
        for name, s, e in zip(names, edges, edges[1:]):
            self.count[order[s:e]] = unpack(given[int(name)], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        # a text begins in a context of its own, which occurs as often as texts end
        self.begin = len(self.words)
        end = np.searchsorted(self.words, END)
        self.contexts, self.context_count = np.append(self.words, BEGIN), np.append(self.count, self.count[end])
        self.before = np.concatenate(([self.begin], self.tokens[:-1]))
        self.before[self.first] = self.begin

    def pairs(self, least: int, buckets: int, hot: int):
        """Pairs that may be arcs: both words are frequent enough. Sorted by bucket, context and piece of it, then word."""
        base = self.begin + 1
        ok = (self.context_count[self.before] >= least) & (self.count[self.tokens] >= least)
        self.pair, place = np.unique((self.before * base + self.tokens)[ok], return_inverse=True)
        seen = np.bincount(place[np.repeat(~self.held, self.sizes)[ok]], minlength=len(self.pair)) if len(self.pair) else np.zeros(0, np.int64)
        context, word = self.pair // base, self.pair % base
        pieces = -(-self.context_count // hot)
        piece = (mix(self.words[word]) % np.maximum(pieces[context], 1).astype(np.uint64)).astype(np.int64)
        # every context of the shard is asked for, with all its pieces, so that what its arcs leave is whole
        asked = np.flatnonzero(self.context_count >= least)
        many = np.maximum(pieces[asked], 1)
        context_all = np.concatenate((context, np.repeat(asked, many)))
        piece_all = np.concatenate((piece, np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)))
        span = int(pieces.max(initial=1)) + 1
        entry, at = np.unique(context_all * span + piece_all, return_inverse=True)
        self.entry_context = entry // span
        name = mix(self.contexts[self.entry_context] + (entry % span).astype(np.uint64) * _PIECE)
        bucket = (mix(name) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((name, bucket))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.entry_context, name, bucket = self.entry_context[order], name[order], bucket[order]
        at = rank[at[:len(self.pair)]]
        sort = np.lexsort((self.words[word], at))
        self.pair, at, seen, word = self.pair[sort], at[sort], seen[sort], word[sort]
        runs = np.bincount(at, minlength=len(name))
        names, starts = np.unique(bucket, return_index=True)
        self.entry_edges = np.append(starts, len(bucket))
        self.pair_edges = np.concatenate(([0], np.cumsum(runs)))[self.entry_edges]
        self.buckets = names
        return name, runs, self.words[word], seen


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _ask_pairs(word_buckets: int, buckets: int, least: int, hot: int):
    def run(batches):
        for row in _rows(batches):
            texts = _Texts(row, word_buckets)
            name, runs, word, seen = texts.pairs(least, buckets, hot)
            e, p = texts.entry_edges, texts.pair_edges
            cut = list(zip(e, e[1:], p, p[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts.buckets, pa.int64()), pa.array([texts.shard] * len(cut), pa.int64()),
                 *(pa.array(x, pa.binary()) for x in ([_ascending(name[a:b]) for a, b, _, _ in cut], [pack(runs[a:b].astype(np.uint32)) for a, b, _, _ in cut],
                                                      [pack(word[c:d]) for _, _, c, d in cut], [pack(seen[c:d].astype(np.int64)) for _, _, c, d in cut]))],
                ["bucket", "shard", "names", "runs", "words", "seen"])
    return run


_PAIR_ANSWER = "shard long, bucket long, counts binary, mass binary, arcs binary, once long, twice long"


def _answer_pairs(least: int):
    def run(table: pa.Table) -> pa.Table:
        """Counts of pairs over the whole corpus, and per context (or piece of one) the sum and number of those that are arcs."""
        names = [_summed(x) for x in table["names"].to_pylist()]
        runs = [unpack(x, np.uint32).astype(np.int64) for x in table["runs"].to_pylist()]
        words = [unpack(x, np.uint64) for x in table["words"].to_pylist()]
        known, entry = np.unique(np.concatenate(names), return_inverse=True)
        owner, word = np.repeat(entry, np.concatenate(runs)), np.concatenate(words)
        order = np.lexsort((word, owner))
        owner, word = owner[order], word[order]
        fresh = np.concatenate(([True], (owner[1:] != owner[:-1]) | (word[1:] != word[:-1]))) if len(word) else np.zeros(0, bool)
        pair = np.empty(len(word), np.int64)
        pair[order] = np.cumsum(fresh) - 1
        counts = np.bincount(pair, np.concatenate([unpack(x, np.int64) for x in table["seen"].to_pylist()]), int(fresh.sum())).astype(np.int64)
        arc = counts >= least
        mass = np.bincount(owner[fresh][arc], counts[arc], len(known)).astype(np.int64)
        arcs = np.bincount(owner[fresh][arc], minlength=len(known))
        e, p = np.cumsum([0, *map(len, names)]), np.cumsum([0, *map(len, words)])
        bucket, none = table["bucket"][0].as_py(), [None] * len(names)
        return pa.table({
            "shard": pa.array([*table["shard"].to_pylist(), -1]), "bucket": pa.array([bucket] * (len(names) + 1)),
            "counts": pa.array([*(pack(counts[pair[s:t]]) for s, t in zip(p, p[1:])), None], pa.binary()),
            "mass": pa.array([*(pack(mass[entry[s:t]]) for s, t in zip(e, e[1:])), None], pa.binary()),
            "arcs": pa.array([*(pack(arcs[entry[s:t]]) for s, t in zip(e, e[1:])), None], pa.binary()),
            "once": pa.array([*none, int((counts == 1).sum())], pa.int64()), "twice": pa.array([*none, int((counts == 2).sum())], pa.int64())})
    return run


class Automaton:
    """States 0 to n - 1 are the contexts of a shard, n is the empty state. An arc (state, word) carries the log-probability of the word
    and leads to the word's state; without one the failure arc, with its weight, leads to the empty state, which has an arc for every word."""

    def __init__(self, arcs: np.ndarray, arc_weight: np.ndarray, failure: np.ndarray, word_weight: np.ndarray, base: int):
        order = np.argsort(arcs)
        self.arcs, self.arc_weight = arcs[order], arc_weight[order]
        self.failure, self.word_weight, self.base = failure, word_weight, base

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and log-probabilities after one token of several texts."""
        weight = self.failure[state] + self.word_weight[word]
        if len(self.arcs):
            key = state * self.base + word
            at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            hit = self.arcs[at] == key
            weight[hit] = self.arc_weight[at[hit]]
        return word, weight

    def run(self, tokens: np.ndarray, first: np.ndarray, sizes: np.ndarray, begin: int) -> np.ndarray:
        """Log-probability of each text. Long texts are followed in stretches, each from the state that its predecessor's last
        token leads to; all stretches take one step at a time."""
        many = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(sizes)), many)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        start = first[owner] + part * STRETCH
        length = np.minimum(sizes[owner] - part * STRETCH, STRETCH)
        state = np.where(part == 0, begin, tokens[np.maximum(start - 1, 0)])
        order = np.argsort(-length, kind="stable")
        start, length, state = start[order], length[order], state[order]
        total = np.zeros(len(order))
        for i in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -i, side="left"))
            state, weight = self.step(state[:live], tokens[start[:live] + i])
            total[:live] += weight
        back = np.empty(len(order))
        back[order] = total
        return np.bincount(owner, back, len(sizes))


def _score(word_buckets: int, buckets: int, least: int, hot: int, total: int, kinds: int, discount: float, id_kind: pa.DataType):
    def run(batches):
        for row in _rows(batches):
            texts = _Texts(row, word_buckets)
            texts.pairs(least, buckets, hot)
            counts, mass, arcs = (np.zeros(n, np.int64) for n in (len(texts.pair), len(texts.entry_context), len(texts.entry_context)))
            given = {a["bucket"]: a for a in row["pair_answers"] or []}
            e, p = texts.entry_edges, texts.pair_edges
            for name, a, b, c, d in zip(texts.buckets, e, e[1:], p, p[1:]):
                answer = given[int(name)]
                counts[c:d] = unpack(answer["counts"], np.int64)
                mass[a:b], arcs[a:b] = unpack(answer["mass"], np.int64), unpack(answer["arcs"], np.int64)
            single = (texts.count + 1) / (total + kinds + 1)
            base = texts.begin + 1
            spent = np.bincount(texts.entry_context, mass - discount * arcs, base)
            backoff = 1 - spent / np.maximum(texts.context_count, 1)
            arc = counts >= least
            context, word = texts.pair[arc] // base, texts.pair[arc] % base
            seen = (counts[arc] - discount) / texts.context_count[context] + backoff[context] * single[word]
            automaton = Automaton(texts.pair[arc], np.log10(seen), np.log10(backoff), np.log10(single), base)
            score = automaton.run(texts.tokens, texts.first, texts.sizes, texts.begin)
            logs = np.log10(single)[texts.tokens]
            owner = np.repeat(np.arange(len(texts.sizes)), texts.sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts.ids, id_kind), pa.array(texts.held), pa.array(texts.sizes), pa.array(np.bincount(owner, texts.count[texts.tokens] > 0, len(texts.sizes)).astype(np.int64)),
                 pa.array(np.full(len(texts.sizes), total)), pa.array(np.bincount(owner, logs, len(texts.sizes))), pa.array(score)],
                ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def language_model_scores(docs: DataFrame, held_out: F.Column, least: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log10 probability of every text under a model learned from the rows where `held_out` is false or null.

    Tokens are words between ASCII white space, with only A-Z lower-cased, then one end. The single-word model is
    p1 = (c + 1) / (N + V + 1), with one further kind for all unknown words. After a context, a pair seen `least` times or more has
    (c - d) / C + b p1 and any other word b p1: d is the absolute discount n1 / (n1 + 2 n2) from the pairs of such frequent words seen once and twice, C the count of the
    context (a word, or the beginning of a text) and b what the discounted pairs leave, so each context sums to 1. Words
    are told apart by 64-bit hashes.

    A null text is empty and, like an empty one, is one end token; repeated rows are learned and scored as often as they stand; ids may be
    null or shared; without any training row every probability is 1; an empty table gives no rows; other columns are ignored.
    Returns id, held_out, n_tokens, n_known, train_tokens, base_score (of the single words) and score."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    shape = StructType([StructField("shard", LongType()), StructField("ids", ArrayType(id_type)), StructField("held", ArrayType(BooleanType())),
                        *(StructField(n, BinaryType()) for n in ("sizes", "tokens", "words", "trained")), StructField("n_words", LongType()), StructField("n_tokens", LongType())])
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # rows of a shard stay where their task wrote them: later steps move counts, not texts
    shards = bucketed(given.mapInArrow(_gather, shape), "shard", "fragmentos")
    words, tokens = shards.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    word_buckets, buckets = 1 + (words or 0) // ASKED, 1 + (tokens or 0) // ASKED
    asked = shards.select("shard", "words", "trained").mapInArrow(_ask_words(word_buckets), "bucket long, shard long, words binary, trained binary")
    answers = materialize(asked.groupBy("bucket").applyInArrow(_answer_words, _ANSWER), "contagens")
    total, kinds = (x or 0 for x in answers.where("shard < 0").agg(F.sum("total"), F.sum("kinds")).first())
    hot = max(HOT, total // TOP)
    counted = answers.where("shard >= 0").groupBy("shard").agg(F.collect_list(F.struct("bucket", "counts")).alias("answers"))
    known = shards.drop("trained").join(counted.hint("merge"), "shard")
    pairs = known.mapInArrow(_ask_pairs(word_buckets, buckets, least, hot), "bucket long, shard long, names binary, runs binary, words binary, seen binary")
    replies = materialize(pairs.groupBy("bucket").applyInArrow(_answer_pairs(least), _PAIR_ANSWER), "pares")
    once, twice = (x or 0 for x in replies.where("shard < 0").agg(F.sum("once"), F.sum("twice")).first())
    discount = once / (once + 2 * twice) if once and twice else 0.5
    paired = replies.where("shard >= 0").groupBy("shard").agg(F.collect_list(F.struct("bucket", "counts", "mass", "arcs")).alias("pair_answers"))
    id_kind = given.select("id").limit(0).toArrow().schema.field("id").type
    out = StructType([StructField(id_col, id_type), StructField("held_out", BooleanType())]).add("n_tokens", "long").add("n_known", "long").add(
        "train_tokens", "long").add("base_score", "double").add("score", "double")
    scored = known.join(paired.hint("merge"), "shard", "left").mapInArrow(_score(word_buckets, buckets, least, hot, total, kinds, discount, id_kind), out)
    return scored
