"""Runs of equal ``key`` in sorted Arrow batches, for operators that compare what shares a key."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Table, bool]]:
    """Tables of whole runs, with False; or, with True, parts of runs that have over ``limit`` rows.

    The batches are those of one partition, sorted by ``key`` (long, ascending).  No more than a batch and ``limit`` rows
    are held at a time.
    """
    held, late = None, None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        key = table.column("key").to_numpy()
        begin = 0
        if late is not None:
            begin = int(np.searchsorted(key, late, side="right"))
            if begin:
                yield table.slice(0, begin), True
            late = late if begin == len(key) else None
        last = max(begin, int(np.searchsorted(key, key[-1])))
        if last > begin:
            yield from _by_length(table.slice(begin, last - begin), limit)
        held = table.slice(last)
        if held.num_rows > limit:
            yield held, True
            held, late = None, key[-1]
    if held is not None and held.num_rows:
        yield from _by_length(held, limit)


def _by_length(table: pa.Table, limit: int) -> Iterator[tuple[pa.Table, bool]]:
    starts, sizes = bounds(table)
    if (sizes <= limit).all():
        yield table, False
        return
    long = pa.array(np.repeat(sizes > limit, sizes))
    yield table.filter(long), True
    yield table.filter(pa.compute.invert(long)), False


def bounds(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of a table start, and how many rows they have."""
    key = table.column("key").to_numpy()
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    return starts, np.diff(np.r_[starts, len(key)])


def forest(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the first row of its component."""
    label = np.arange(len(near), dtype=np.int32)
    while True:
        lower = np.minimum(label, np.where(near, label[None, :], np.int32(len(near))).min(axis=1))
        lower = np.minimum(lower, lower[lower])
        if np.array_equal(lower, label):
            return label
        label = lower
