"""Words of Arrow text columns as numpy arrays; texts stay UTF-8 bytes, no Python strings are made."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes taken up at a time, so that temporary arrays stay small. A longer document is taken up whole.
GROUP = 1 << 21
#: Bytes hashed at a time.
BLOCK = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: For `bytes.translate`, several times faster than indexing: lower-cased, and whether a byte is no white space.
LOWERED, INSIDE = LOWER.tobytes(), (~SPACE).tobytes()

STEP = np.uint64(0x9E3779B97F4A7C15)
STEP_INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * STEP)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP**i and its inverse, modulo 2**64, for i < n at least."""
    if n > len(_powers.get("up", ())):
        for name, base in (("up", STEP), ("down", STEP_INVERSE)):
            all_ = np.full(max(n, BLOCK), base, np.uint64)
            all_[0] = 1
            _powers[name] = np.multiply.accumulate(all_)
    return _powers["up"], _powers["down"]


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, limit: int = GROUP) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most `limit` bytes, or a single longer row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def hashes(data: np.ndarray, starts: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
    """64-bit hashes of the byte ranges from `starts` to each of `ends`, of which the first reach farthest.

    The ranges to the first ends are in order and don't overlap.
    """
    out = [np.empty(len(starts), np.uint64) for _ in ends]
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends[0], base + BLOCK, side="right")))
        part = data[base:ends[0][j - 1]]
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE[part] * up[:len(part)], out=sums[1:])
        a = starts[i:j] - base
        low, back = sums[a], down[a]
        for k, end in enumerate(ends):
            out[k][i:j] = (sums[end[i:j] - base] - low) * back
        i = j
    return [mix(h + (end - starts).astype(np.uint64) * STEP) for h, end in zip(out, ends, strict=True)]


def runs(inside: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; no run goes across a place in `cuts`."""
    n = len(inside)
    cuts = cuts[(cuts > 0) & (cuts < n)]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    starts[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and row of every word between white space, A-Z lower-cased, and the words' place in `data`."""
    raw = data.tobytes()
    low, inside = np.frombuffer(raw.translate(LOWERED), np.uint8), np.frombuffer(raw.translate(INSIDE), bool)
    starts, ends = runs(inside, offsets[1:-1])
    return hashes(low, starts, ends)[0], np.searchsorted(offsets[1:], starts, side="right"), starts


def shingles(word: np.ndarray, row: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each run of k words (of all words, if a row has fewer), its row, and words by row."""
    counts = np.bincount(row, minlength=rows)
    firsts = np.cumsum(counts) - counts
    left = counts[row] - (np.arange(len(row)) - firsts[row])  # words from here to the row's end
    ok = np.flatnonzero((left >= k) | (left == counts[row]))
    total = np.zeros(len(ok), np.uint64)
    for j, salt in enumerate(np.arange(1, k + 1, dtype=np.uint64) * STEP):
        at = np.minimum(ok + j, max(len(word) - 1, 0))
        with_ = j < left[ok]
        total = mix(total + np.where(with_, word[at], np.uint64(0)) + salt)
    return total, row[ok], counts
