"""Near-duplicate documents by bottom-k sketches of one hash function, verified on full shingle sets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaflow.llm.arrow import column, lists, runs, slices, text_bytes, whole_groups
from vendaflow.llm.components import connected_components
from vendaflow.llm.hashing import mix, shingle_sets
from vendaflow.llm.tables import bucketed
from vendaflow.session import materialize

SHINGLE = 5
#: Retained values per document, values that feed inverted lists, members of a list that one task compares at once.
KEEP, LISTED, BLOCK = 128, 16, 512
#: Standard errors of the sketch estimate (values drawn from the union without replacement) that a link may fall below the limit.
SLACK = 4.5
_STEP = np.uint64(0x9FB21C651E98DF25)
_BYTES = 1 << 20
_SIG = "id {kind}, n long, d1 long, d2 long, keys array<long>"
_PAD = np.uint64(2**64 - 1)


def _signatures(batches):
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        parts = []
        for a, b in slices(offsets, _BYTES):
            values, n = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], SHINGLE)
            at = np.cumsum(n) - n
            digests = []
            for seed in (0x51ED270B, 0x2545F4914F6CDD1D):
                sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(values + np.uint64(seed)))))
                digests.append((sums[at + n] - sums[at]).view(np.int64))
            listed = np.minimum(n, LISTED)
            where = np.repeat(at, listed) + np.arange(listed.sum()) - np.repeat(np.cumsum(listed) - listed, listed)
            before = np.where(where == np.repeat(at, listed), np.uint64(1), values[np.maximum(where - 1, 0)] if len(values) else np.uint64(0))
            key = mix(before * _STEP + values[where]) if len(where) else np.zeros(0, np.uint64)
            parts.append((n, *digests, key.view(np.int64), listed))
        if parts:
            n, d1, d2, key, listed = (np.concatenate([p[i] for p in parts]) for i in range(5))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(d1), pa.array(d2), lists(key, listed, pa.int64())],
                                             ["id", "n", "d1", "d2", "keys"])


def _sets(batches):
    """id, n, digests asked for, text -> id, n, the k smallest values, all values (little-endian bytes)."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        for a, b in slices(offsets, _BYTES):
            values, n = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], SHINGLE)
            at = np.cumsum(n) - n
            whole = [values[s:s + m].tobytes() for s, m in zip(at, n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([w[:8 * KEEP] for w in whole], pa.binary()),
                 pa.array(whole, pa.binary()), pa.array(n)], ["id", "want", "sketch", "full", "n"])


def _estimates(sketch: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of padded sketches: values common to both among the smallest of the union, and how many those are."""
    both = np.sort(np.concatenate([sketch[i], sketch[j]], 1), 1)
    twin = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != _PAD)
    fresh = both != _PAD
    fresh[:, 1:] &= ~twin
    rank = np.cumsum(fresh, 1)
    common = (twin & (rank[:, 1:] <= KEEP)).sum(1)
    return common, np.minimum(rank[:, -1], KEEP)


def _comparer(percent: int, by_component: bool):
    limit = percent / 100

    def least(small, large):
        """Lowest estimate with which sets of these sizes may still be linked."""
        union = (small + large) / (1 + limit)
        return limit - SLACK * math.sqrt(limit * (1 - limit) / KEEP) * np.sqrt(np.clip((union - KEEP) / np.maximum(union - 1, 1), 0, 1))

    def first_common(padded, lengths, i, j, key):
        """Whether this list is the first, by key, of those that hold both."""
        heads = padded[:, :LISTED]
        before = np.concatenate([np.ones((len(heads), 1), np.uint64), heads[:, :-1]], 1)
        keys = np.where(np.arange(LISTED) < lengths[:, None], mix(before * _STEP + heads), np.uint64(0))
        out = np.zeros(len(i), bool)
        for s in range(0, len(i), 4096):
            a, b = keys[i[s:s + 4096]], keys[j[s:s + 4096]]
            both = (a[:, :, None] == b[:, None, :]).any(2) & (a != 0)
            out[s:s + 4096] = np.where(both, a, _PAD).min(1) == key
        return out

    def compare(n, block, component, key, values, lengths):
        """Passing pairs (i, j, common, union, exact) of one list or pair of blocks, each in the first of its lists only."""
        m = len(n)
        at = np.cumsum(lengths) - lengths
        _, codes, often = np.unique(values, return_inverse=True, return_counts=True)
        twice = often > 1
        number = np.cumsum(twice) - 1
        mine = twice[codes]
        marks = np.zeros((m, int(twice.sum())), np.float32)
        marks[np.repeat(np.arange(m), lengths)[mine], number[codes[mine]]] = 1
        split = block != block[0]
        if split.any():
            left, right = np.flatnonzero(~split), np.flatnonzero(split)
            shared = marks[left] @ marks[right].T
            small, large = np.minimum.outer(n[left], n[right]), np.maximum.outer(n[left], n[right])
        else:
            left = right = np.arange(m)
            shared = np.triu(marks @ marks.T, 1)
            small, large = np.minimum.outer(n, n), np.maximum.outer(n, n)
        maybe = (100 * small >= percent * large) & (shared >= least(small, large) * np.minimum(KEEP, large) - 1e-6) & (shared > 0)
        if by_component:
            maybe &= component[left][:, None] != component[right][None, :]
        i, j = np.nonzero(maybe)
        whole = shared[i, j].astype(np.int64)
        i, j = left[i], right[j]
        if not len(i):
            return i, j, i, i, i
        padded = np.full((m, KEEP), _PAD)
        padded[np.repeat(np.arange(m), lengths), np.arange(len(values)) - np.repeat(at, lengths)] = values
        mine = first_common(padded, lengths, i, j, key)
        i, j, whole = i[mine], j[mine], whole[mine]
        if not len(i):
            return i, j, i, i, i
        parts = [_estimates(padded, i[s:s + 4096], j[s:s + 4096]) for s in range(0, len(i), 4096)]
        common, union = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        # two whole sets: every common value counts, also where the union has more than k values
        exact = (n[i] <= KEEP) & (n[j] <= KEEP)
        common = np.where(exact, whole, common)
        union = np.where(exact, n[i] + n[j] - common, union)
        ok = np.where(exact, 100 * common >= percent * union, common >= least(n[i], n[j]) * union)
        return i[ok], j[ok], common[ok], union[ok], exact[ok]

    def forest(i, j, weight, m):
        """Pairs of a heaviest spanning forest."""
        root = list(range(m))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        kept = []
        for p in np.argsort(-weight, kind="stable"):
            a, b = find(i[p]), find(j[p])
            if a != b:
                root[a] = b
                kept.append(p)
        return np.array(kept, np.int64)

    def run(batches):
        for table in whole_groups(batches, "g", 512):
            ids, n, block, key = (table[c].to_numpy() for c in ("id", "n", "block", "key"))
            component = table["component"].to_numpy() if by_component else ids
            data, offsets = text_bytes(column(table, "sketch"))
            values = np.frombuffer(data.tobytes(), np.uint64)
            lengths, ends = np.diff(offsets) // 8, offsets // 8
            out = []
            edges = runs(table["g"].to_numpy())
            for a, b in zip(edges, edges[1:]):
                if b - a < 2 or (by_component and (component[a:b] == component[a]).all()):
                    continue
                i, j, common, union, exact = compare(n[a:b], block[a:b], component[a:b], key[a:a + 1].view(np.uint64)[0], values[ends[a]:ends[b]], lengths[a:b])
                if len(i) and not by_component:
                    kept = forest(i, j, common / union, b - a)
                    i, j, exact = i[kept], j[kept], exact[kept]
                if len(i):
                    x, y = ids[a + i], ids[a + j]
                    out.append((np.minimum(x, y), np.maximum(x, y), exact))
            if out:
                x, y, exact = (np.concatenate([o[k] for o in out]) for k in range(3))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(exact)], ["a", "b", "exact"])

    return run


def _verifier(percent: int):
    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(u, v, assume_unique=True))
                good.append(100 * common >= percent * (len(u) + len(v) - common))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])
    return run


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose sets of 5-word shingles have a Jaccard similarity of `percent` / 100 or more, chained.

    A document keeps the k smallest hashes of its set. Documents with equal sets form a class (a combine before the shuffle,
    so huge groups of copies are cheap) and only its smallest id goes on. Inverted lists hold each class under every run of two
    neighbouring values (the first: from the start) among its 16 smallest; two sets at the limit have no such run in common with
    a probability of about 2e-6. Long lists are cut into blocks, and tasks compare blocks: common values, then, in the
    first list that holds both, the estimate from the union's k smallest, which may fall 4.5 standard errors below the limit. Two sets of at most k values each are decided there, by all
    their values; other pairs are verified on full sets. First only a heaviest spanning forest of each list is verified; then, in lists that
    still hold several components, all pairs that pass and lie in different ones. So no link that would join components is lost, and a group's links are
    never written out in full.

    A document without words has an empty set and links with nothing, nor does one with a null id (component null, kept
    true). Repeated rows share their component. Ids must be integers; other columns are ignored; an empty table gives no rows.
    Returns id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sig = materialize(given.mapInArrow(_signatures, _SIG.format(kind="long")), "esbocos")
    content = ["n", "d1", "d2"]
    usable = sig.where("n > 0 and id is not null")
    classes = materialize(usable.groupBy(*content).agg(F.min("id").alias("rep"), F.first("keys").alias("keys")), "classes")
    listed = classes.select("rep", F.explode("keys").alias("key"))
    multiple = materialize(listed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
                           .select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "listas")
    entries = materialize(listed.join(multiple, "key").select("rep", "key", "blocks"), "entradas")
    wanted = entries.select("rep").distinct().join(classes.select("rep", *content), "rep").select(
        F.col("rep").alias("id"), F.col("n").alias("want"))
    # the ids grow with the corpus: never a broadcast, the same plan at every size
    texts = given.join(wanted.hint("merge"), "id").select("id", "want", "text")
    sets = bucketed(texts.mapInArrow(_sets, "id long, want long, sketch binary, full binary, n long").where("n = want")
                    .select("id", "n", "sketch", "full"), "id", "conjuntos")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")

    def members(rows: DataFrame) -> DataFrame:
        """List entries with their sketches, once for every block that their own block meets."""
        return (rows.select("rep", "key", "component", mine.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
                .select(F.col("rep").alias("id"), "block", "key", "component",
                        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("g"))
                .join(sets.select("id", "n", "sketch"), "id"))

    def pairs(rows: DataFrame, by_component: bool) -> DataFrame:
        dealt = rows.repartition(parts, "g").sortWithinPartitions("g", "id")
        found = dealt.mapInArrow(_comparer(percent, by_component), "a long, b long, exact boolean")
        return materialize(found.distinct(), "pares")

    full = sets.select("id", "full")

    def verified(found: DataFrame) -> DataFrame:
        sized = found.where("not exact").select("a", "b")
        with_a = sized.join(full.select(F.col("id").alias("a"), F.col("full").alias("fa")), "a")
        with_both = with_a.join(full.select(F.col("id").alias("b"), F.col("full").alias("fb")), "b").select("a", "b", "fa", "fb")
        checked = with_both.mapInArrow(_verifier(percent), "a long, b long")
        return materialize(checked.unionAll(found.where("exact").select("a", "b")), "ligacoes")

    alone = entries.withColumn("component", F.col("rep"))
    first = materialize(connected_components(verified(pairs(members(alone), False))), "componentes")
    labelled = materialize(entries.join(first.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")), "entradas")
    mixed = materialize(labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                        .where("low < high").select("key"), "mistas")
    rest = verified(pairs(members(labelled.join(mixed, "key")), True))
    final = materialize(connected_components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(rest)), "componentes")
    rooted = materialize(classes.select(*content, "rep").join(final.select(F.col("node").alias("rep"), "component"), "rep", "left")
                         .select(*content, F.coalesce("component", "rep").alias("component")), "raizes")
    light = sig.select("id", *content)
    return light.join(rooted, content, "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component", "id")).alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"))
