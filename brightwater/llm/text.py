"""Words and hashes of whole texts, in numpy, over Arrow batches.

Words are runs of anything but ``[\\x20\\x09-\\x0D]``. Texts are taken in
slices of a few megabytes so that memory does not follow the batch; a text
longer than a slice is taken alone, and hashed block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if "up" not in _tables or len(_tables["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BACK)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _tables[name] = np.cumprod(table)
    return _tables["up"], _tables["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row begins (one more than rows); null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if lower:
        column = pc.ascii_lower(column)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def row_slices(bounds: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes, ``SLICE_BYTES`` by default; a longer row stands alone."""
    most = most or SLICE_BYTES
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def word_spans(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in the bytes, and each row's first word (one more than rows)."""
    n = len(raw)
    if n == 0:
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing, np.zeros(len(bounds), dtype=np.int64)
    inside = ~_SPACE[raw]
    cut = np.zeros(n + 1, dtype=bool)
    cut[bounds] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside
    ends[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: a polynomial of random byte values, mixed with the length."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        block = raw[base : ends[last - 1]]
        up, down = _powers(len(block) + 1)
        sums = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[block] * up[: len(block)], out=sums[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive word hashes (across rows too; callers cut)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n].copy()
    for i in range(1, size):
        out *= _BASE
        out += words[i : i + n]
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit values as Spark's longs."""
    return x.view(np.int64)
