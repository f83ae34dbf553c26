"""Sorted groups in Arrow batches, for tasks that look at one group at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by their first ``keys``
    columns (integers).  A table holds about a batch and one group more."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(b.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        change[0] = bool(held) and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in enumerate(columns))
        at = np.flatnonzero(change)
        if len(at):
            if held or at[-1]:
                yield pa.Table.from_batches([*held, b.slice(0, at[-1])])
            held = [b.slice(at[-1])]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(table: pa.Table, keys: int) -> np.ndarray:
    """First row of every group of a table, and its number of rows."""
    change = np.zeros(table.num_rows, bool)
    for k in range(keys):
        c = table.column(k).to_numpy()
        change[1:] |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(change), [table.num_rows]])


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A column of equally long lists as rows of a matrix."""
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).reshape(-1, width)


def lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """A column of lists as arrays."""
    out: list[np.ndarray] = []
    for c in column.chunks:
        flat, ends = c.flatten().to_numpy(zero_copy_only=False), c.offsets.to_numpy()
        out += np.split(flat, ends[1:-1] - ends[0])
    return out
