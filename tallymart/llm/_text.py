"""Words of whole texts as byte positions and 64-bit keys, computed over Arrow buffers.

Both word classes of the operators are sets of ASCII characters or of everything outside
ASCII, so they can be told byte by byte in UTF-8 and no text has to be decoded.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Texts of one step are bounded by bytes and rows, so temporary arrays stay small; a longer
# text is a step of its own.
STEP_BYTES = 1 << 19
STEP_ROWS = 4096

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SPACE_SEPARATED = np.ones(256, dtype=bool)
SPACE_SEPARATED[[32, 9, 10, 11, 12, 13]] = False

ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

# Words and marks apart: letters, digits and what is beyond ASCII; all else but white space.
TOKENS = np.where(ALPHANUMERIC, 1, 2).astype(np.uint8)
TOKENS[~SPACE_SEPARATED] = 0

_RANDOM = np.random.default_rng(20_240_501)
_BYTE_KEYS = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers = {_BASE: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}


def _power_table(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(max(n, STEP_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base]


def give_back() -> None:
    """Return freed memory to the system: a worker process is kept for the next task, which
    may need little, and executors count what it holds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Texts(NamedTuple):
    """Consecutive rows of a batch: their lower-cased bytes and where each text starts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    prefixes: tuple[np.ndarray, ...]


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[Texts]:
    """Cut a text column into runs of whole texts of about ``limit`` bytes; null is empty."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    texts = column.fill_null("") if column.null_count else column
    n = len(texts)
    if not n:
        return
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, bounds, data = texts.cast(pa.string() if width == np.int32 else pa.large_string()).buffers()
    offsets = np.frombuffer(bounds, width, n + 1, texts.offset * np.dtype(width).itemsize)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offsets, int(offsets[row]) + limit, side="right")) - 1
        stop = min(max(stop, row + 1), row + STEP_ROWS, n)
        part = offsets[row : stop + 1].astype(np.int64)
        yield Texts(row, _LOWER[raw[part[0] : part[-1]]], part - part[0])
        row = stop
    give_back()


def words(texts: Texts, classes: np.ndarray, prefixes: tuple[int, ...] = ()) -> Words:
    """All maximal runs of bytes of one class, in order; class 0 (or False) is in none.

    ``prefixes`` adds keys of each word's first bytes, one array for each length.
    """
    inside = classes[texts.data]
    n = len(inside)
    if not n:
        none = np.empty(0, np.int64)
        return Words(none, none, none, none.view(np.uint64), tuple(none.view(np.uint64) for _ in prefixes))
    bounds = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
    change = np.ones(n, bool)
    change[1:] = inside[1:] != inside[:-1]
    change[bounds] = True
    start = np.flatnonzero(change & (inside != 0))
    last = np.ones(n, bool)
    last[:-1] = change[1:]
    end = np.flatnonzero(last & (inside != 0)) + 1
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_KEYS[texts.data] * _power_table(_BASE, n)[:n], out=sums[1:])
    back = _power_table(_INVERSE, n + 1)[start]
    key = mix((sums[end] - sums[start]) * back)
    doc = np.searchsorted(texts.offsets[1:], start, side="right")
    parts = tuple(mix((sums[np.minimum(end, start + k)] - sums[start]) * back + np.uint64(k)) for k in prefixes)
    return Words(doc, start, end, key, parts)
