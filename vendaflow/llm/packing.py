"""Documents packed into fixed-length sequences: linear grouping of lengths, configurations of few sizes, best fit of the rest."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.llm.tokens import encode
from vendaflow.session import materialize

CAPACITY = 2048
#: Lengths above this are large; the number of groups they are rounded in.
LARGE, GROUPS = 192, 48
_PIECE = "id {kind}, piece int, start long, length long, ids_crc32 long"


def _cutter(tokenizer: str, capacity: int, end_id: int):
    def run(batches):
        for batch in batches:
            ids, out = batch.column(0), []
            for row, text in enumerate(batch.column(1).to_pylist()):
                tokens = np.append(encode(text, tokenizer), np.uint32(end_id)).astype("<u4")
                first = len(tokens) % capacity or capacity
                cuts = [0, *range(first, len(tokens) + 1, capacity)] if len(tokens) > capacity else [0, len(tokens)]
                out += [(row, piece, a, b - a, zlib.crc32(tokens[a:b].tobytes())) for piece, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            columns = list(zip(*out)) or [(), (), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:])],
                ["id", "piece", "start", "length", "ids_crc32"])
    return run


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Pieces of at most `capacity` ids of every whole text followed by `end_id`; only the first of several may be shorter."""
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return given.mapInArrow(_cutter(tokenizer, capacity, end_id), _PIECE.format(kind=given.schema["id"].dataType.simpleString()))


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Fractional optimum of the few-size problem: how often to use which multiset of sizes (column generation)."""
    k = len(sizes)
    columns = [np.eye(k, dtype=int)[i] * (capacity // sizes[i]) for i in range(k)]
    basis = np.array(columns, float).T
    for _ in range(40 * k):
        inverse = np.linalg.inv(basis)
        amounts = inverse @ demand
        prices = np.ones(k) @ inverse
        best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for room in range(1, capacity + 1):
            fits = np.flatnonzero(sizes <= room)
            best[room] = best[room - 1]
            if len(fits):
                gain = best[room - sizes[fits]] + prices[fits]
                top = int(np.argmax(gain))
                if gain[top] > best[room] + 1e-12:
                    best[room], choice[room] = gain[top], fits[top]
        if best[capacity] <= 1 + 1e-7:
            break
        new, room = np.zeros(k), capacity
        while room > 0:
            if choice[room] < 0:
                room -= 1
                continue
            new[choice[room]] += 1
            room -= sizes[choice[room]]
        direction = inverse @ new
        rows = direction > 1e-9
        if not rows.any():
            break
        ratio = np.where(rows, amounts / np.where(rows, direction, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = new
    amounts = np.linalg.inv(basis) @ demand
    return [(basis[:, i].astype(int), float(x)) for i, x in enumerate(amounts) if x > 1e-9]


def _draw(queue: list[list[int]], n: int) -> list[list[int]]:
    """The next `n` items of a group as runs [length, count]; length 0 where the group has run out."""
    runs = []
    while n and queue:
        length, count = queue[0]
        part = min(n, count)
        runs.append([length, part])
        n -= part
        queue[0][1] -= part
        if not queue[0][1]:
            queue.pop(0)
    return [*runs, [0, n]] if n else runs


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where items go, by length: rows (length, first rank, count, first sequence, offset), for whole stretches of ranks.

    `histogram` holds the number of items of each length, `capacity` entries at most, so the plan depends on lengths and counts,
    not on the number of documents. Large lengths, longest first, are split into groups of equal cardinality and rounded up to
    the longest of their group; configurations of those few sizes are optimised and rounded down; the items themselves, never
    longer than their group's size, take the places; what is left, then the small ones, goes longest first to the fullest
    sequence that has room."""
    used: dict[int, int] = defaultdict(int)
    rows: list[tuple[int, int, int, int, int]] = []
    next_sequence = 0
    open_by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def take(length: int, count: int, sequence: int, offset: int) -> None:
        rows.append((length, used[length], count, sequence, offset))
        used[length] += count

    for length in (x for x in histogram if x == capacity):
        take(length, histogram[length], 0, 0)
        next_sequence = histogram[length]
    large = [(x, n) for x, n in sorted(histogram.items(), reverse=True) if LARGE < x < capacity and n]
    total = sum(n for _, n in large)
    if total:
        size_of_group = -(-total // GROUPS)
        groups: list[list[list[int]]] = [[]]
        room = size_of_group
        for length, count in large:
            while count:
                if not room:
                    groups.append([])
                    room = size_of_group
                part = min(room, count)
                groups[-1].append([length, part])
                room -= part
                count -= part
        merged: dict[int, list[list[int]]] = {}
        for group in groups:
            merged.setdefault(group[0][0], []).extend(group)
        sizes = np.array(list(merged), int)
        demand = np.array([sum(n for _, n in g) for g in merged.values()], float)
        queues = list(merged.values())
        for config, amount in _configurations(sizes, demand, capacity):
            left = int(amount + 1e-6)
            drawn = [_draw(queues[i], left) for i, n in enumerate(config) for _ in range(n)]
            while left and drawn:
                batch, offset = min(runs[0][1] for runs in drawn), 0
                for runs in drawn:
                    length = runs[0][0]
                    if length:
                        take(length, batch, next_sequence, offset)
                        offset += length
                    runs[0][1] -= batch
                    if not runs[0][1]:
                        runs.pop(0)
                if offset:
                    open_by_room[capacity - offset].append((next_sequence, batch))
                    next_sequence += batch
                left -= batch
    for length in sorted((x for x in histogram if x < capacity), reverse=True):
        left = histogram[length] - used[length]
        for room in range(length, capacity + 1):
            if not left:
                break
            stretches = open_by_room.pop(room, None)
            if not stretches:
                continue
            each = room // length
            while stretches and left:
                sequence, count = stretches.pop()
                whole = min(count, left // each)
                if whole:
                    for j in range(each):
                        take(length, whole, sequence, capacity - room + j * length)
                    open_by_room[room - each * length].append((sequence, whole))
                    left -= whole * each
                if whole < count and left:
                    for j in range(left):
                        take(length, 1, sequence + whole, capacity - room + j * length)
                    open_by_room[room - left * length].append((sequence + whole, 1))
                    left, whole = 0, whole + 1
                if whole < count:
                    stretches.append((sequence + whole, count - whole))
            open_by_room[room].extend(stretches)
        if left:
            each = capacity // length
            whole = left // each
            if whole:
                for j in range(each):
                    take(length, whole, next_sequence, j * length)
                open_by_room[capacity - each * length].append((next_sequence, whole))
                next_sequence += whole
                left -= whole * each
            if left:
                for j in range(left):
                    take(length, 1, next_sequence, j * length)
                open_by_room[capacity - left * length].append((next_sequence, 1))
                next_sequence += 1
    return rows


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Pack every whole document, followed by `end_id`, into as few sequences of `capacity` tokens as the scheme finds.

    Texts are encoded once where they lie; the pieces (no ids, only their checksum) are written. Their lengths' histogram, at
    most `capacity` rows, is all that the driver plans with. Pieces of a length get ranks by counting within (length, salt)
    and adding the counts of earlier salts, so a length that very many documents share is numbered by many tasks; a rank
    falls into one stretch of the plan, which gives sequence and offset.

    Null text is empty (one piece: `end_id`); null ids and repeated rows are packed like others; an empty table gives no
    rows; other columns are ignored. Returns id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = materialize(cut_pieces(docs, tokenizer, capacity, id_col, text_col, end_id), "pedacos")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = materialize(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "contagens")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = counts.select("length", "salt", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32", "start")
    ranked = salted.withColumn("nth", F.row_number().over(order) - 1).join(materialize(before, "antes"), ["length", "salt"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    stretches = defaultdict(list)
    for length, first, count, sequence, offset in plan(histogram, capacity):
        stretches[length].append((first, sequence, offset))
    def place(batches):
        for batch in batches:
            size = np.asarray(batch.column(3))
            rank = np.asarray(batch.column(5))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for length in np.unique(size):
                mine = np.flatnonzero(size == length)
                firsts, sequences, offsets = by_length.value[int(length)]
                at = np.searchsorted(firsts, rank[mine], side="right") - 1
                sequence[mine] = sequences[at] + rank[mine] - firsts[at]
                offset[mine] = offsets[at]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(5)], pa.array(sequence), pa.array(offset)],
                [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    # the plan: stretches per length, bounded by the number of lengths and configurations
    by_length = spark.sparkContext.broadcast(
        {length: tuple(np.array(x, np.int64) for x in zip(*found)) for length, found in stretches.items()})
    kind = pieces.schema["id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
