"""Words and shingles of Arrow text batches with numpy.

Words are runs of ASCII letters, digits and non-ASCII bytes, in lower case;
everything else separates.  Hashes are 64-bit and depend on the bytes alone,
so they agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SHINGLE_WORDS = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IS_WORD = np.zeros(256, dtype=bool)
for _lo, _hi in (("0", "9"), ("a", "z"), ("A", "Z")):
    _IS_WORD[ord(_lo):ord(_hi) + 1] = True
_IS_WORD[128:] = True

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x + _GOLD).astype(np.uint64, copy=False)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(256, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.full(max(n, 2 * len(self.up)), _BASE, dtype=np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = _INVERSE
            self.down = np.cumprod(steps)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunks(offsets: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``chunk_bytes``; a longer row stands alone."""
    n, start = len(offsets) - 1, 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + chunk_bytes, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield start, stop
        start = stop


@dataclass
class Words:
    """The words of some rows: hash, row and bytes of each, and words per row."""

    hashes: np.ndarray
    rows: np.ndarray
    counts: np.ndarray
    lengths: np.ndarray


def words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the rows that ``offsets`` (starting at 0) cut from ``raw``."""
    n_rows = len(offsets) - 1
    if len(raw) == 0:
        return Words(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(n_rows, np.int64), np.zeros(0, np.int64))
    inside = _IS_WORD[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    stops = np.flatnonzero(inside & (~after | edge[1:])) + 1
    up, down = _POWERS.to(len(raw) + 1)
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[_LOWER[raw]] * up[:-1], out=sums[1:])
    hashes = mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return Words(hashes, rows, np.bincount(rows, minlength=n_rows), stops - starts)


_PLACES = mix(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of five words.  A row of one to four words
    has one shingle of all its words."""
    n, k = len(w.hashes), SHINGLE_WORDS
    firsts = np.cumsum(w.counts) - w.counts
    out_h, out_r = [], []
    if n >= k:
        whole = w.rows[: n - k + 1] == w.rows[k - 1:]
        acc = w.hashes[: n - k + 1] * _PLACES[0]
        for j in range(1, k):
            acc += w.hashes[j: n - k + 1 + j] * _PLACES[j]
        out_h.append(mix(acc[whole]))
        out_r.append(w.rows[: n - k + 1][whole])
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    if len(short):
        acc = w.hashes[firsts[short]] * _PLACES[0]
        for j in range(1, k - 1):
            more = w.counts[short] > j
            acc[more] += w.hashes[firsts[short][more] + j] * _PLACES[j]
        out_h.append(mix(acc))
        out_r.append(short)
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, r = np.concatenate(out_h), np.concatenate(out_r)
    if len(out_h) == 2:
        order = np.argsort(r, kind="stable")
        h, r = h[order], r[order]
    return h, r


def distinct_shingles(h: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) in row order, and how often each occurs."""
    if len(h) == 0:
        return h, r, np.zeros(0, np.int64)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.empty(len(h), dtype=bool)
    new[0] = True
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return h[at], r[at], np.diff(np.append(at, len(h)))
