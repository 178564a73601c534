"""Rows that lie sorted by a key, handed to numpy a run of whole groups at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows gathered before they are handed on, so that many small groups are taken up at once.
ROWS = 4096


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables in which no group of equal first columns is cut; batches come sorted by that column."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        if sum(b.num_rows for b in kept) < ROWS:
            continue
        table = pa.Table.from_batches(kept)
        last = table.column(0)[-1]
        here = pc.equal(table.column(0), last)
        cut = table.num_rows - pc.sum(here).as_py()
        if cut:
            yield table.slice(0, cut)
        kept = table.slice(cut).combine_chunks().to_batches()
    if kept:
        yield pa.Table.from_batches(kept)


def bounds(keys: np.ndarray) -> np.ndarray:
    """Where groups of equal neighbours begin, and the end."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(1, np.int64)


def smallest_linked(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 in order, the smallest node that links (a, b) lead to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
