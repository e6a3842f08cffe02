"""Vectorised words: hashes of the words of many texts at once, from Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 22
BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = int(_rng.integers(0, 2**62, dtype=np.uint64)) * 2 + 1
_STEP = _rng.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}

# Words are separated by these bytes only: space and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
# ASCII letters in lower case.
FOLD = _fold
# Everything in ASCII that is neither letter nor digit separates plain words.
PLAIN = np.zeros(256, bool)
PLAIN[:128] = True
PLAIN[48:58] = PLAIN[65:91] = PLAIN[97:123] = False


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        n = max(n, BLOCK_BYTES + 4096)
        up = np.full(n, _BASE, np.uint64)
        down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.cumprod(up), np.cumprod(down)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def groups(
    column: pa.Array, size: int = GROUP_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``size`` bytes: first row, bytes, offsets within them."""
    if not len(column):
        return
    data, offsets = buffers(column)
    low = 0
    while low < len(offsets) - 1:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), len(offsets) - 1)
        yield low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE, fold=None):
    """Hash, begin, end and row of each word; words do not reach over rows."""
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    first[cuts] = inside[cuts]
    cuts = offsets[1:][offsets[1:] > 0] - 1
    last[cuts] = inside[cuts]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(begin), np.uint64)
    low = 0
    while low < len(begin):
        at = begin[low]
        high = max(int(np.searchsorted(end, at + BLOCK_BYTES, "right")), low + 1)
        part = data[at : end[high - 1]]
        up, down = _power_table(len(part) + 1)
        values = _BYTE[part if fold is None else fold[part]] * up[: len(part)]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        b, e = begin[low:high] - at, end[low:high] - at
        hashes[low:high] = (sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64)
        low = high
    rows = np.searchsorted(offsets, begin, "right") - 1
    return mix(hashes), begin, end, rows


def runs(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` consecutive words of one row, and where it begins."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * _STEP[k]
    at = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return mix(total[at]), at


def bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Where the entries of each of ``n`` rows begin and end in a sorted array of rows."""
    return np.searchsorted(rows, np.arange(n + 1))
