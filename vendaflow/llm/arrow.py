"""Small helpers between Arrow batches and numpy, used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a non-null string column, and the offsets of its rows (one more than rows)."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    ends = ends.astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[ends[0]:ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes; a row that is longer stands alone."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(rows, max(to, at + 1))
        yield at, to
        at = to


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column whose rows are consecutive stretches of `values`."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def whole_groups(batches, key: str, least: int = 2048) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches that come sorted by `key` within a partition; about `least` rows or one group."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        while table.num_rows:
            keys = table[key].to_numpy()
            if rows < least or not held:
                held.append(table.slice(0, min(least, table.num_rows)))
                rows += held[-1].num_rows
                table = table.slice(held[-1].num_rows)
                continue
            last = held[-1][key][-1].as_py()
            same = int(np.argmax(keys != last)) if (keys != last).any() else len(keys)
            if same:
                held.append(table.slice(0, same))
                rows += same
            table = table.slice(same)
            if table.num_rows:
                yield pa.concat_tables(held).combine_chunks()
                held, rows = [], 0
    if held:
        yield pa.concat_tables(held).combine_chunks()


def runs(keys: np.ndarray) -> np.ndarray:
    """Bounds of stretches of equal keys: start of each, and the end."""
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])) if len(keys) else np.zeros(1, np.int64)


def column(table: pa.Table, name: str) -> pa.Array:
    """A column as one array."""
    found = table[name]
    return found.chunk(0) if found.num_chunks == 1 else found.combine_chunks()
