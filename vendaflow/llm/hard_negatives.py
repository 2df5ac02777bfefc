"""Hard negatives of anchor vectors: an inverted multi-index over both halves, walked by upper bounds of the inner product.

Two codebooks, one per half of the vector, form a grid of cells. For an anchor, the bound of a cell is the sum of its halves' bounds:
the inner product with the codeword plus the length of the anchor's half times the codeword's radius. A heap visits cells in falling order of that
sum. The walk ends where the bound of the next cell certifies that no row outside the visited cells can enter the result, so results are exact."""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.llm.arrow import lists
from vendaflow.session import materialize

#: Vectors, chosen by hash, that fit the codebooks; every row is indexed, and radii and counts come from all rows.
FIT_ROWS = 8_192
#: Rows aimed at per cell, and codewords per half at most: a task holds figures of CODES ** 2 cells (some 6 MB).
CELL, CODES = 64, 512
#: Rows of one part of the index, visiting anchors that meet a part in one task, rows that the first walk reads at least.
PART, VISITORS, FIRST = 4_096, 8_192, 2_048
LONG = np.iinfo(np.int64)

_ROW = "row long, id long, label long, q binary"


def _floor(width: int):
    def run(batches):
        """floor(256 x) as doubles, filled with zeros up to `width`; vectors that leave the range of doubles are left out."""
        for batch in batches:
            vectors = batch.column(3)
            sizes = np.diff(vectors.offsets.to_numpy())
            with np.errstate(over="ignore"):
                flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * 256.0) + 0.0
            out = np.zeros((len(sizes), width))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            out[owner, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
            keep = np.flatnonzero(np.isfinite(out).all(1))
            fixed = [batch.column(i).take(pa.array(keep)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array([out[i].tobytes() for i in keep], pa.binary())], ["row", "id", "label", "q"])
    return run


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact where doubles are; larger ones in whole numbers, cut at the range of a long."""
    with np.errstate(over="ignore"):
        if a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 2**53:
            return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    return np.array([[min(max(sum(int(x) * y for x, y in zip(row, other)), LONG.min), LONG.max) for other in whole] for row in a], np.int64).reshape(len(a), len(b))


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The closest codeword of each vector and the distance to it, from the difference itself."""
    with np.errstate(over="ignore", invalid="ignore"):
        found = np.argmin((centres**2).sum(1)[None, :] - 2 * x @ centres.T, 1)
        return found, np.sqrt(((x - centres[found]) ** 2).sum(1))


def _codebook(x: np.ndarray, codes: int, rng, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), codes, replace=False)].copy()
    for _ in range(rounds):
        near, _ = _nearest(x, centres)
        count = np.bincount(near, minlength=codes)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres


@dataclass
class Grid:
    """Codebooks and radii of the halves; per cell (first codeword * codes + second) its rows, its first part and its parts."""

    first: np.ndarray
    second: np.ndarray
    radius: tuple[np.ndarray, np.ndarray] | None = None
    rows: np.ndarray | None = None
    part: np.ndarray | None = None
    split: np.ndarray | None = None

    @property
    def codes(self) -> int:
        return len(self.first)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Upper bounds of both halves' inner products with any row of a codeword, then lower ones."""
        cut, up, low = self.first.shape[1], [], []
        with np.errstate(over="ignore", invalid="ignore"):
            for half, centres, radius in zip((x[:cut], x[cut:]), (self.first, self.second), self.radius):
                middle, spread = centres @ half, np.sqrt((half**2).sum()) * radius
                slack = 1e-9 * (np.abs(centres) @ np.abs(half) + spread) + 1e-9
                up.append(np.nan_to_num(middle + spread + slack, nan=np.inf))
                low.append(np.nan_to_num(middle - spread - slack, nan=-np.inf))
        return *up, *low

    def walk(self, x: np.ndarray, low: float = -np.inf, high: float = np.inf):
        """(bound, cell) of cells with rows that may score between `low` and `high`, in falling order of the bound: a heap over two sorted
        sequences, which holds one open cell per started row of the grid."""
        up1, up2, low1, low2 = self.bounds(x)
        one, two = np.argsort(-up1, kind="stable"), np.argsort(-up2, kind="stable")
        heap = [(-(up1[one[0]] + up2[two[0]]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if -bound < low:
                return
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (-(up1[one[i + 1]] + up2[two[0]]), i + 1, 0))
            if j + 1 < len(two):
                heapq.heappush(heap, (-(up1[one[i]] + up2[two[j + 1]]), i, j + 1))
            cell = int(one[i]) * self.codes + int(two[j])
            if self.rows[cell] and low1[one[i]] + low2[two[j]] <= high:
                yield -bound, cell

    def visits(self, x: np.ndarray, low: float, high: float, done: float | None) -> list[int]:
        """Cells of the first walk (`done` is None: until FIRST rows), or those that remain after it down to the bound `done`."""
        seen, out = 0, []
        for bound, cell in self.walk(x, low, high):
            if seen < FIRST:
                seen += int(self.rows[cell])
                if done is None:
                    out.append(cell)
            elif done is None or bound < done:
                break
            else:
                out.append(cell)
        return out


def _assign(grid: Grid, width: int):
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(3), width)
            cut = grid.first.shape[1]
            (i, d1), (j, d2) = _nearest(x[:, :cut], grid.first), _nearest(x[:, cut:], grid.second)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i * grid.codes + j), pa.array(d1), pa.array(d2)], ["row", "id", "label", "q", "cell", "d1", "d2"])
    return run


_VISIT = "part long, cells array<int>, anchor long, label long, q binary, low array<long>, high array<long>, least array<long>"


def _visit(grid: Grid, width: int, last: bool):
    def run(batches):
        """Anchors with the lists of cells that they visit, by part of the index. `low` and `high` bound the scores of each window,
        `least` is the score that a row must reach to matter."""
        for batch in batches:
            rows, owner, parts, cells = batch.num_rows, [], [], []
            vectors = _matrix(batch.column(2), width)
            low, high, least = (batch.column(i).to_pylist() for i in (3, 4, 5))
            for a in range(rows):
                found = np.array(grid.visits(vectors[a], min(low[a]), max(high[a]), min(least[a]) if last else None), np.int64)
                found = np.repeat(found, grid.split[found])
                if not len(found):
                    continue
                where = grid.part[found]
                again = np.concatenate(([False], found[1:] == found[:-1]))
                run_start = np.maximum.accumulate(np.where(again, 0, np.arange(len(found))))
                where = where + np.arange(len(found)) - run_start
                order = np.argsort(where, kind="stable")
                edges = np.flatnonzero(np.concatenate(([True], np.diff(where[order]) > 0, [True])))
                for s, e in zip(edges, edges[1:]):
                    owner.append(a)
                    parts.append(where[order[s]])
                    cells.append(found[order[s:e]])
            flat = np.array(list(chain.from_iterable(cells)), np.int32)
            kept = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int64()), lists(flat, np.array([len(c) for c in cells], np.int64), pa.int32()),
                 *(batch.column(i).take(kept) for i in range(6))], ["part", "cells", "anchor", "label", "q", "low", "high", "least"])
    return run


_FOUND = "anchor long, place int, score long, id long, row long"


def _score(width: int, most: int, same: bool):
    def run(visits: pa.Table, rows: pa.Table) -> pa.Table:
        """The best `most` rows of each anchor and window among the visited cells of one part."""
        out = [np.zeros(0, np.int64)] * 5
        if visits.num_rows and rows.num_rows:
            x, y = _matrix(visits["q"], width), _matrix(rows["q"], width)
            cell, label = rows["cell"].to_numpy(), rows["label"].to_numpy()
            ids, numbers = rows["id"].to_numpy(), rows["row"].to_numpy()
            anchors, labels = visits["anchor"].to_numpy(), visits["label"].to_numpy()
            bounds = [visits[c].to_pylist() for c in ("low", "high", "least")]
            visited, found = visits["cells"].to_pylist(), []
            for start in range(0, len(x), 256):
                scores = _products(x[start:start + 256], y)
                for a in range(start, start + len(scores)):
                    mine = np.flatnonzero(np.isin(cell, visited[a]) & ((label == labels[a]) == same) & (numbers != anchors[a]))
                    score = scores[a - start][mine]
                    for place, (low, high, least) in enumerate(zip(*(b[a] for b in bounds))):
                        ok = np.flatnonzero((score >= max(low, least)) & (score <= high))
                        ok = ok[np.lexsort((numbers[mine[ok]], ids[mine[ok]], ~score[ok]))[:most]]
                        found.append((np.full(len(ok), anchors[a]), np.full(len(ok), place), score[ok], ids[mine[ok]], numbers[mine[ok]]))
            if found:
                out = [np.concatenate(c) for c in zip(*found)]
        return pa.table([pa.array(out[0]), pa.array(out[1].astype(np.int32)), *map(pa.array, out[2:])], ["anchor", "place", "score", "id", "row"])
    return run


class _Index:
    """Rows dealt to the parts of the grid, and the walks of anchors over them."""

    def __init__(self, rows: DataFrame, width: int, fit_rows: int):
        self.spark, self.width = rows.sparkSession, width
        sample = rows.orderBy(F.xxhash64("id", "row"), "row").limit(fit_rows).select("q").collect()
        x = np.array([np.frombuffer(r["q"], np.float64) for r in sample]).reshape(-1, width)
        codes = int(min(CODES, len(x), max(1, np.ceil(np.sqrt(rows.count() / CELL)))))
        cut, rng = (width + 1) // 2, np.random.default_rng(7)
        self.grid = grid = Grid(_codebook(x[:, :cut], codes, rng), _codebook(x[:, cut:], codes, rng))
        placed = materialize(rows.mapInArrow(_assign(grid, width), f"{_ROW}, cell long, d1 double, d2 double"), "celas")
        # one row per occupied cell, codes ** 2 at most
        cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).toArrow().sort_by("cell")
        cell, n = cells["cell"].to_numpy(), cells["n"].to_numpy()
        grid.radius = (np.zeros(codes), np.zeros(codes))
        np.maximum.at(grid.radius[0], cell // codes, np.nan_to_num(cells["d1"].to_numpy(), nan=np.inf))
        np.maximum.at(grid.radius[1], cell % codes, np.nan_to_num(cells["d2"].to_numpy(), nan=np.inf))
        grid.rows, grid.part, grid.split = (np.zeros(codes * codes, np.int64) for _ in range(3))
        grid.rows[cell], small = n, n <= PART
        grid.part[cell[small]] = (np.cumsum(n[small]) - 1) // PART
        split = -(-n[~small] // PART)
        grid.split[cell[small]], grid.split[cell[~small]] = 1, split
        grid.part[cell[~small]] = (grid.part[cell[small]].max(initial=-1) + 1) + np.cumsum(split) - split
        deal = self.spark.createDataFrame(pa.table({"cell": cell, "first": grid.part[cell], "split": grid.split[cell]}))
        part = F.col("first") + F.pmod(F.xxhash64("id", "row"), "split")
        self.rows = materialize(placed.join(F.broadcast(deal), "cell").select(part.alias("part"), "row", "id", "label", "q", F.col("cell").cast("int").alias("cell")), "indice")

    def search(self, anchors: DataFrame, most: int, same: bool, last: bool) -> DataFrame:
        """Rows that anchors (anchor, label, q, low, high, least) find in one walk: the best of every visited part. Parts that very many anchors visit meet them in several tasks."""
        met = materialize(anchors.select("anchor", "label", "q", "low", "high", "least").mapInArrow(_visit(self.grid, self.width, last), _VISIT), "visitas")
        sizes = materialize(met.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("slices")), "fatias")
        left = met.join(sizes, "part").withColumn("slice", F.pmod(F.xxhash64("anchor"), "slices").cast("int")).drop("slices")
        every = sizes.select("part", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
        right = self.rows.join(every, "part")
        return materialize(left.groupBy("part", "slice").cogroup(right.groupBy("part", "slice")).applyInArrow(_score(self.width, most, same), _FOUND), "achados")


def _best(found: DataFrame, most: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def _two_walks(index: _Index, anchors: DataFrame, most: int, same: bool) -> DataFrame:
    """The best `most` rows of every window of the anchors: a first walk over some cells, then on from there until the next bound is below
    the `most`-th score already found, which certifies the window."""
    first = index.search(anchors, most, same, False)
    reached = _best(first, most).where(F.col("rank") == most).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("reached"))
    least = F.transform("low", lambda low, i: F.greatest(low, F.coalesce(F.try_element_at("reached", i), low)))
    known = anchors.join(reached, "anchor", "left").withColumn("least", F.when(F.col("reached").isNull(), F.col("low")).otherwise(least))
    return materialize(_best(first.unionAll(index.search(known, most, same, True)), most), "melhores")


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), anchor_every: int = 100,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", fit_rows: int = FIT_ROWS) -> DataFrame:
    """The best `negatives` rows of another label for each anchor and each of its `positives` best rows of its own label, with a score of
    window[0] to window[1] percent of the positive's. Exact: walks stop only at certified bounds.

    Anchors are the rows whose id is divisible by `anchor_every`. Components become floor(256 x); scores are inner products of whole
    numbers, higher first, ties by the smaller id. Rows with a null id, label or vector or a null or non-finite component take no part;
    of rows equal in id, label and vector one counts; different rows that share an id stand each for itself, ties among them in any order; a shorter vector
    counts as filled with zeros; scores beyond the range of a long are cut to it; an anchor without a positive, or a positive without a
    negative in its window, has no rows; an empty table gives none; other columns are ignored. Returns anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    valid = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & sound).distinct()
    valid = materialize(valid.select(F.monotonically_increasing_id().alias("row"), "id", "label", "v"), "validos")
    width = valid.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    width = max(2, width)
    rows = materialize(valid.mapInArrow(_floor(width), _ROW), "inteiros")
    if rows.isEmpty():
        return hard_negatives(vectors.limit(0), id_col=id_col, vector_col=vector_col, label_col=label_col)
    index = _Index(rows, width, fit_rows)
    anchors = rows.where(F.col("id") % anchor_every == 0).select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "label", "q")

    def ends(column, value):
        return F.array(F.lit(value).cast("long")).alias(column)

    everything = anchors.select("*", ends("low", int(LONG.min)), ends("high", int(LONG.max)), ends("least", int(LONG.min)))
    chosen = _two_walks(index, everything, positives, True)
    low, high = (F.expr(f"(cast(score as decimal(20,0)) * {percent} + {up}) div 100") for percent, up in ((window[0], 99), (window[1], 0)))
    sought = chosen.where("score >= 0").select("anchor", F.struct("rank", low.alias("low"), high.alias("high"), F.col("id").alias("positive_id"), "score").alias("w"))
    grouped = sought.groupBy("anchor").agg(F.array_sort(F.collect_list("w")).alias("w"))
    windows = materialize(anchors.join(grouped, "anchor").select("*", F.col("w.low").alias("low"), F.col("w.high").alias("high"), F.col("w.low").alias("least")), "janelas")
    found = _two_walks(index, windows, negatives, False)
    return found.join(windows.select("anchor", "anchor_id", "w"), "anchor").select(
        "anchor_id", F.col("w")[F.col("place")]["positive_id"].alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("w")[F.col("place")]["score"].alias("positive_score"), F.col("score").alias("negative_score"))
