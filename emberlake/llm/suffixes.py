"""Numpy parts of the repeated-passage search: anchors, records, suffix sort.

A window is a string of ``LENGTH`` bytes within one document.  Its anchor is
the leftmost least-hashed ``K``-gram in it; equal windows have equal anchors
at equal offsets.  Consecutive windows with the same anchor form a run, and
the bytes under a run are its region.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from emberlake.llm.text import _BYTE, _POWERS, mix

LENGTH = 50
K = 24
SPAN = LENGTH - K + 1  # K-grams in a window, and the most windows in a run
REGION = LENGTH + SPAN - 1
SEGMENT = 1 << 22
_POS = np.uint64((1 << 23) - 1)


@dataclass
class Runs:
    """Runs of windows: anchor hash, region hash, document, first window,
    number of windows and anchor position."""

    h: np.ndarray
    region: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray


def _prefix(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the polynomial hash, and the inverse powers."""
    up, down = _POWERS.to(len(raw) + 1)
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[raw] * up[:-1], out=sums[1:])
    return sums, down


def _segment_runs(raw: np.ndarray, doc: np.ndarray, base: int) -> list[np.ndarray]:
    sums, down = _prefix(raw)
    h = mix((sums[K:] - sums[:-K]) * down[: len(raw) - K + 1])
    least = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width:])
    n = len(raw) - LENGTH + 1
    anchor = (least[:n] & _POS).astype(np.int64)
    valid = np.flatnonzero(doc[:n] == doc[LENGTH - 1: LENGTH - 1 + n])
    if not len(valid):
        return []
    at, of = anchor[valid], doc[valid]
    new = np.empty(len(valid), dtype=bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | (of[1:] != of[:-1])
    head = np.flatnonzero(new)
    windows = np.diff(np.append(head, len(valid)))
    first, a = valid[head], at[head]
    stop = first + windows + LENGTH - 1
    shape = ((a - first) * 128 + windows).astype(np.uint64)
    region = mix((sums[stop] - sums[first]) * down[first] + mix(shape))
    return [h[a], region, of[head], first + base, windows, a + base]


def anchor_runs(raw: np.ndarray, offsets: np.ndarray) -> Runs:
    """The runs of the documents that ``offsets`` cut from ``raw``."""
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    parts = []
    for s in range(0, max(0, len(raw) - LENGTH + 1), SEGMENT):
        stop = s + SEGMENT + LENGTH - 1
        got = _segment_runs(raw[s:stop], doc[s:stop], s)
        if got:
            parts.append(got)
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return Runs(none.astype(np.uint64), none.astype(np.uint64), none, none, none, none)
    return Runs(*[np.concatenate(x) for x in zip(*parts, strict=True)])


class Suffixes:
    """Windows of some records, compared eight bytes at a time.

    ``data`` has one record a row (zero-padded); a suffix is a record and an
    offset, of which ``LENGTH`` bytes count.
    """

    def __init__(self, data: np.ndarray, record: np.ndarray, offset: np.ndarray):
        spare = -(-LENGTH // 8) * 8  # a word may start near the last record's end
        self.flat = np.concatenate([data.ravel(), np.zeros(spare, dtype=np.uint8)])
        self.at = record.astype(np.int64) * data.shape[1] + offset

    def word(self, s: np.ndarray, w: int) -> np.ndarray:
        """The ``w``-th eight bytes of the suffixes ``s`` as one number, which
        sorts as they do."""
        words = np.ndarray((len(self.flat) - 7,), dtype="<u8", buffer=self.flat, strides=(1,))
        out = words[self.at[s] + 8 * w].byteswap()
        beyond = 8 * (w + 1) - LENGTH
        return out >> np.uint64(8 * beyond) if beyond > 0 else out

    def classes(self, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order within each run of equal ``groups`` and, in that
        order, the class of equal windows.

        A radix sort from the first word on: a round orders the suffixes that
        are equal so far by their next word, and those that differ from all
        others are done.  Only a class that is out of order is sorted."""
        n = len(groups)
        order = np.arange(n)
        if n == 0:
            return order, order
        cut = np.append(True, groups[1:] != groups[:-1])  # a class begins here
        left = np.flatnonzero(~(cut & np.append(cut[1:], True)))  # in classes of two or more
        for w in range(-(-LENGTH // 8)):
            if not len(left):
                break
            cls = np.cumsum(cut[left])
            key = self.word(order[left], w)
            falls = (key[1:] < key[:-1]) & (cls[1:] == cls[:-1])
            if falls.any():
                mixed = np.zeros(cls[-1] + 1, dtype=bool)
                mixed[cls[1:][falls]] = True
                some = np.flatnonzero(mixed[cls])
                by = some[np.lexsort((key[some], cls[some]))]
                order[left[some]] = order[left[by]]
                key[some] = key[by]
            cut[left[1:]] |= key[1:] != key[:-1]
            begins = cut[left]
            left = left[~(begins & np.append(begins[1:], True))]
        return order, np.cumsum(cut) - 1


def repeated_windows(data: np.ndarray, lengths: np.ndarray, anchors: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """For each record a bit mask of its windows that a record of smaller
    rank has too.  ``anchors`` are the anchors' offsets in the records."""
    if len(lengths) == 0:
        return np.zeros(0, dtype=np.uint32)
    windows = lengths - LENGTH + 1
    record = np.repeat(np.arange(len(lengths)), windows)
    offset = np.arange(len(record)) - np.repeat(np.cumsum(windows) - windows, windows)
    up, down = _POWERS.to(data.shape[1] + 1)
    sums = np.zeros((len(data), data.shape[1] + 1), dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], axis=1, out=sums[:, 1:])
    i = np.arange(len(data))
    h = mix((sums[i, anchors + K] - sums[i, anchors]) * down[anchors])
    group = h[record] + mix((anchors[record] - offset).astype(np.uint64))
    by_group = np.argsort(group)
    group, record, offset = group[by_group], record[by_group], offset[by_group]
    edge = np.append(True, group[1:] != group[:-1])
    size = np.diff(np.append(np.flatnonzero(edge), len(group)))
    keep = np.repeat(size > 1, size)
    group, record, offset = group[keep], record[keep], offset[keep]
    masks = np.zeros(len(lengths), dtype=np.uint32)
    if not len(record):
        return masks
    order, classes = Suffixes(data, record, offset).classes(group)
    rank = ranks[record[order]]
    first = np.minimum.reduceat(rank, np.flatnonzero(np.append(True, classes[1:] != classes[:-1])))
    repeated = order[rank > first[classes]]
    np.bitwise_or.at(masks, record[repeated], np.uint32(1) << offset[repeated].astype(np.uint32))
    return masks
