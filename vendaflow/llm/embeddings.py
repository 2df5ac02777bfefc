"""Near-duplicate vectors by an inverted multi-index: two codebooks, cells visited nearest first, pairs verified."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaflow.llm.arrow import column, lists, runs, text_bytes, whole_groups
from vendaflow.llm.components import connected_components
from vendaflow.session import materialize

#: Vectors, chosen by hash, that fit the codebooks and the number of cells to visit; every vector is indexed.
FIT_ROWS = 8_192
RECALL = 0.97
#: Vectors aimed at per cell, codewords per half at most, members of a cell that one task compares at once. With 256 codewords a
#: fitted vector of `FIT_ROWS` stands for 1/32 of one; more would follow single vectors. Beyond some 4 million vectors of a label
#: cells therefore grow, and are compared in more blocks.
CELL, CODES, BLOCK = 64, 256, 512


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 10) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.argmin(_distances(x, centres), 1)
        for c in range(k):
            mine = x[near == c]
            if len(mine):
                centres[c] = mine.mean(0)
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)[None, :]


class MultiIndex:
    """Independent codebooks on the two halves of unit vectors; their product is a grid of cells."""

    def __init__(self, first: np.ndarray, second: np.ndarray, visits: int):
        self.first, self.second, self.visits = first, second, visits

    @classmethod
    def fit(cls, sample: np.ndarray, codes: int, threshold: float, recall: float) -> MultiIndex:
        """Codebooks by k-means. The number of cells to visit is the rank of the cell that holds a neighbour exactly at the
        threshold, in a random direction, that `recall` of sampled vectors do not exceed."""
        rng = np.random.default_rng(11)
        half = sample.shape[1] // 2
        codes = max(1, min(codes, len(sample)))
        index = cls(_kmeans(sample[:, :half], codes, rng), _kmeans(sample[:, half:], codes, rng), codes * codes)
        probe = sample[:2048]
        aside = rng.normal(size=probe.shape)
        aside = _unit(aside - (aside * probe).sum(1, keepdims=True) * probe)
        near = threshold * probe + np.sqrt(1 - threshold**2) * aside
        ranks = np.sort(index.ranks(probe, index.cells(near, 1)[:, 0]))
        index.visits = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))])
        return index

    def ranks(self, x: np.ndarray, cells: np.ndarray, chunk: int = 16) -> np.ndarray:
        """How many cells each vector must visit to come to the given one of its own: those whose sum is not larger, counted a few
        vectors at a time, so that the whole grid is held for `chunk` vectors only."""
        half, out = x.shape[1] // 2, []
        for s in range(0, len(x), chunk):
            d1, d2 = _distances(x[s:s + chunk, :half], self.first), _distances(x[s:s + chunk, half:], self.second)
            i, j = np.divmod(cells[s:s + chunk], len(self.second))
            at = np.arange(len(d1))
            out.append((d1[:, :, None] + d2[:, None, :] <= (d1[at, i] + d2[at, j])[:, None, None]).sum((1, 2)))
        return np.concatenate(out)

    def cells(self, x: np.ndarray, visits: int) -> np.ndarray:
        """The nearest `visits` cells of each vector, nearest first: sums of the halves' distances, merged from two sorted
        sequences; a cell (i, j) among the first v of the order has (i + 1) * (j + 1) <= v in the sorted ranks."""
        half = x.shape[1] // 2
        d1, d2 = _distances(x[:, :half], self.first), _distances(x[:, half:], self.second)
        o1, o2 = np.argsort(d1, 1, kind="stable"), np.argsort(d2, 1, kind="stable")
        d1, d2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
        i, j = np.nonzero(np.outer(np.arange(1, d1.shape[1] + 1), np.arange(1, d2.shape[1] + 1)) <= visits)
        best = np.argsort(d1[:, i] + d2[:, j], 1, kind="stable")[:, :visits]
        return np.take_along_axis(o1, i[best], 1) * len(self.second) + np.take_along_axis(o2, j[best], 1)


_VEC = "id long, label long, dim int, cls binary, unit binary"


def _normalise(batches):
    """Valid vectors as unit vectors of doubles; identical input vectors have identical bytes."""
    for batch in batches:
        ids, labels, dims, vectors, units = [], [], [], [], []
        for i, label, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if label is None or not vector or any(v is None for v in vector):
                continue
            x = np.array(vector, np.float64)
            if not np.isfinite(x).all():
                continue
            top = np.abs(x).max()
            if top == 0:
                continue
            scaled = x / top
            unit = scaled / np.linalg.norm(scaled)
            ids.append(i)
            labels.append(label)
            dims.append(len(x))
            vectors.append((x + 0.0).tobytes())
            units.append(unit.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(dims, pa.int32()),
                                          pa.array(vectors, pa.binary()), pa.array(units, pa.binary())], ["id", "label", "dim", "cls", "unit"])


def _assign(index: MultiIndex):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = text_bytes(batch.column(1))
            x = np.frombuffer(data.tobytes(), np.float64).reshape(batch.num_rows, -1)
            found = np.concatenate([index.cells(x[s:s + 512], index.visits) for s in range(0, len(x), 512)])
            n = np.full(len(x), found.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(found.ravel().astype(np.int32), n, pa.int32())],
                                             ["id", "unit", "cells"])
    return run


def _compare(threshold: float):
    def run(batches):
        """Rows of one (label, cell, block pair): members live in the cell, visitors only look into it. A pair is counted where the
        cell's number is the smaller of the cells in which it is found."""
        for table in whole_groups(batches, "g", 1024):
            ids, copies, cell, home, side = (table[c].to_numpy() for c in ("id", "copies", "cell", "home", "side"))
            data, _ = text_bytes(column(table, "unit"))
            units = np.frombuffer(data.tobytes(), np.float64).reshape(len(ids), -1)
            visited = column(table, "cells")
            visited = np.asarray(visited.flatten()).reshape(len(ids), -1)
            linked, weight, edges = [], [], []
            edges_of = runs(table["g"].to_numpy())
            for a, b in zip(edges_of, edges_of[1:]):
                members, seekers = a + np.flatnonzero(side[a:b] == 0), a + np.flatnonzero(side[a:b] == 1)
                if not len(members) or not len(seekers):
                    continue
                i, j = np.nonzero(units[seekers] @ units[members].T >= threshold)
                i, j = seekers[i], members[j]
                inner = home[i] == cell[i]
                twice = (visited[j] == home[i][:, None]).any(1) & ~inner
                ok = np.where(inner, ids[i] < ids[j], ~twice | (cell[i] < home[i]))
                i, j = i[ok], j[ok]
                if len(i):
                    linked += [ids[i], ids[j]]
                    weight += [copies[j], copies[i]]
                    low, high = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
                    edges.append(_forest(low, high))
            if linked:
                node, back = np.unique(np.concatenate(linked), return_inverse=True)
                count = np.bincount(back, np.concatenate(weight)).astype(np.int64)
                pair = np.concatenate(edges)
                none = np.zeros(len(pair), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([node, pair[:, 0]])),
                                                  pa.array(np.concatenate([np.full(len(node), -1), pair[:, 1]])),
                                                  pa.array(np.concatenate([count, none]))], ["a", "b", "n"])
    return run


def _forest(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Edges of a spanning forest of the given pairs."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for x, y in zip(low.tolist(), high.tolist()):
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append((x, y))
    return np.array(kept, np.int64).reshape(-1, 2)


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", recall: float = RECALL, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Links between vectors of one label with a cosine of `threshold` or more, in double precision.

    Identical vectors of a label form a class first and are never paired. Class representatives, as unit vectors, live in one cell
    of the grid and look into their nearest cells, in the order of a multi-sequence traversal, as many as the target recall asks
    for; pairs in a visited cell are verified and counted once. Members and visitors of a cell meet in blocks, so a cell that holds
    very many vectors is compared by many tasks, and only counts per vector and a spanning forest leave a task.

    Vectors that are null, empty, zero or hold a null or non-finite component, and those without a label, link with nothing, nor do
    vectors of different length. Ids must be integers; a null id gets no links and a null component; repeated rows count as
    copies; an empty table gives no rows; other columns are ignored. Returns id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("v"))
    valid = materialize(given.where("id is not null").mapInArrow(_normalise, _VEC), "vetores")
    content = ["label", "dim", F.sha2("cls", 256).alias("digest")]
    keyed = valid.select("id", *content, "unit")
    classes = materialize(keyed.groupBy("label", "dim", "digest").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit")), "classes")
    counts, edges = None, None
    for dim, n in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():
        mine = classes.where(F.col("dim") == dim)
        sample = mine.orderBy(F.xxhash64("rep"), "rep").limit(fit_rows).select("unit").collect()
        data = np.array([np.frombuffer(r["unit"], np.float64) for r in sample])
        if dim == 1:
            data = np.concatenate([data, np.zeros((len(data), 1))], 1)
        largest = mine.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        codes = int(min(CODES, max(1, np.ceil(np.sqrt(largest / CELL)))))
        index = MultiIndex.fit(data, codes, threshold, recall)
        unit = F.col("unit") if dim > 1 else F.concat("unit", F.lit(bytes(8)))
        placed = materialize(mine.select(F.col("rep").alias("id"), unit.alias("unit"))
                             .mapInArrow(_assign(index), "id long, unit binary, cells array<int>"), "celas")
        placed = placed.join(mine.select(F.col("rep").alias("id"), "label", "copies"), "id").withColumn("home", F.get("cells", F.lit(0)))
        sizes = materialize(placed.groupBy("label", "home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
                            .withColumnRenamed("home", "cell"), "tamanhos")
        row = ["id", "copies", "home", "cells", "unit", "label"]
        looks = placed.select(*row, F.explode("cells").alias("cell")).join(sizes, ["label", "cell"])
        slot = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        seek = looks.select(*row, "cell", F.lit(1).alias("side"), slot.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("their"))
        live = looks.where("cell = home").select(*row, "cell", F.lit(0).alias("side"),
                                                 F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("mine"), slot.alias("their"))
        met = seek.unionAll(live).withColumn("g", F.xxhash64("label", "cell", "mine", "their"))
        dealt = met.select("g", "id", "copies", "cell", "home", "side", "unit", "cells").repartition(parts, "g").sortWithinPartitions("g")
        found = materialize(dealt.mapInArrow(_compare(threshold), "a long, b long, n long"), "ligacoes")
        counts = found if counts is None else counts.unionAll(found)
    if counts is None:
        counts = spark.createDataFrame([], "a long, b long, n long")
    linked = counts.where("b < 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    edges = counts.where("b >= 0").select("a", "b")
    parts_of = connected_components(edges).select(F.col("node").alias("rep"), "component")
    rooted = materialize(classes.select("label", "dim", "digest", "rep", "copies").join(linked, "rep", "left").join(parts_of, "rep", "left")
                         .select("label", "dim", "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                                 F.coalesce("component", "rep").alias("component")), "raizes")
    member = materialize(keyed.select("id", "label", "dim", "digest").join(rooted, ["label", "dim", "digest"])
                         .groupBy("id").agg(F.max("links").alias("links"), F.min("component").alias("component")), "membros")
    return given.select("id").join(member, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"), (F.coalesce("component", "id") == F.col("id")).alias("kept"))
