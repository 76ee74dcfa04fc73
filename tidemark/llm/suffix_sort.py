"""Hash-compared suffix sort of short contexts, vectorised over many groups.

A context is a fixed number of bytes around an anchor. Contexts of one anchor
value are sorted by what follows the anchor, in a bottom-up mergesort. Two
suffixes are compared by the length of their common prefix, found by binary
search over equal prefix polynomial hashes: a logarithmic number of steps. All
that is decided by hashes is checked on the bytes afterwards; on a collision
the work is repeated with another base.
"""

from __future__ import annotations

import numpy as np

from .text import byte_values, mix

SLICE = 1 << 14                # contexts sorted at once, if their anchor value allows


class Collision(Exception):
    pass


class Suffixes:
    """Prefix hashes of the rows of a byte matrix; ``left`` bytes lie before the anchor."""

    def __init__(self, rows: np.ndarray, left: int, seed: int):
        self.rows, self.left, self.right = rows, left, rows.shape[1] - left
        base = np.uint64(int(np.random.default_rng(seed).integers(1, 2**62)) * 2 + 1)
        up = np.full(rows.shape[1], base, np.uint64)
        up[0] = 1
        self.up = np.cumprod(up)
        self.h = np.zeros((len(rows), rows.shape[1] + 1), np.uint64)
        np.cumsum(byte_values(seed=seed)[rows] * self.up, axis=1, out=self.h[:, 1:])
        self.after = self.h[:, left:] - self.h[:, left:left + 1]

    def before(self, length: int) -> np.ndarray:
        """Hashes of the ``length`` bytes before the anchor."""
        return self.h[:, self.left] - self.h[:, self.left - length]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix length of the suffixes that start at the anchors of rows a, b."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.right)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.after[a, mid] == self.after[b, mid]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common(a, b)
        at = np.minimum(n, self.right - 1) + self.left
        return np.where(n == self.right, or_equal, self.rows[a, at] < self.rows[b, at])

    def sort(self, group_start: np.ndarray, group_end: np.ndarray) -> np.ndarray:
        """The rows sorted within their groups; rows of a group are consecutive."""
        n = len(self.rows)
        order, place = np.arange(n), np.arange(n)
        width, widest = 1, int((group_end - group_start).max(initial=0))
        while width < widest:
            run = (place - group_start) // width
            other = group_start + (run ^ 1) * width
            low = np.minimum(other, group_end)
            begin, high = low.copy(), np.minimum(other + width, group_end)
            second = run % 2 == 1                          # equal rows of the first run come first
            on = np.flatnonzero(low < high)
            while len(on):
                mid = (low[on] + high[on]) // 2
                ahead = self.less(order[mid], order[on], second[on])
                low[on] = np.where(ahead, mid + 1, low[on])
                high[on] = np.where(ahead, high[on], mid)
                on = on[low[on] < high[on]]
            target = np.where(second, place - width, place) + low - begin
            merged = np.empty(n, np.int64)
            merged[target] = order
            order = merged
            width *= 2
        return order


def earlier_windows(anchor: np.ndarray, doc: np.ndarray, rows: np.ndarray, room_left: np.ndarray,
                    room_right: np.ndarray, left: int, span: int) -> np.ndarray:
    """For each context a bit mask: bit o is set if the ``span`` bytes that start o
    bytes before its anchor also occur around an equal anchor in a smaller document."""
    mask = np.zeros(len(doc), np.uint32)
    for seed in range(1, 64):
        try:
            return _attempt(mask, anchor, doc, rows, room_left, room_right, left, span, seed)
        except Collision:
            mask[:] = 0
    raise RuntimeError("hash collisions with every base")


def _attempt(mask, anchor, doc, rows, room_left, room_right, left, span, seed):
    offsets = np.arange(left + 1)
    fits = (offsets <= room_left[:, None]) & (span - offsets <= room_right[:, None])
    whole = (fits.astype(np.uint32) << offsets.astype(np.uint32)).sum(axis=1, dtype=np.uint32)
    # equal contexts first: all but those of the smallest document are covered
    own = row_hash(rows, seed) ^ mix(anchor + np.uint64(seed)) ^ mix((room_left * 256 + room_right).astype(np.uint64))
    _, rep, inverse = np.unique(own, return_index=True, return_inverse=True)
    least = np.full(len(rep), np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, doc)
    twin = rep[inverse]
    if not ((rows == rows[twin]).all() and (anchor == anchor[twin]).all()):
        raise Collision
    later = doc > least[inverse]
    mask[later] = whole[later]
    # different contexts of one anchor value
    order = rep[np.argsort(anchor[rep], kind="stable")]
    least = least[inverse[order]]
    value = anchor[order]
    edge = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    size = np.diff(np.append(edge, len(order)))
    several = np.repeat(size > 1, size)
    order, least, value = order[several], least[several], value[several]
    size = size[size > 1]
    at = 0
    cuts = np.cumsum(size)
    result = np.zeros(len(order), np.uint32)
    while at < len(order):
        end = int(cuts[max(np.searchsorted(cuts, at + SLICE, "right") - 1, np.searchsorted(cuts, at, "right"))])
        result[at:end] = _windows(rows[order[at:end]], value[at:end], least[at:end], fits[order[at:end]],
                                  left, span, seed)
        at = end
    of_rep = np.zeros(len(mask), np.uint32)
    of_rep[order] = result
    mask[~later] |= of_rep[twin[~later]]
    return mask


def _windows(rows, value, least, fits, left, span, seed):
    s = Suffixes(rows, left, seed)
    n = len(rows)
    new = np.append(True, value[1:] != value[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    order = s.sort(np.repeat(start, size), np.repeat(start + size, size))
    lcp = np.zeros(n, np.int64)
    lcp[1:] = s.common(order[:-1], order[1:])
    lcp[new] = -1
    out = np.zeros(n, np.uint32)
    least = least[order]
    for o in range(left + 1):
        run = np.cumsum(lcp < span - o)                    # rows that agree in span - o bytes from the anchor on
        ok = np.flatnonzero(fits[order, o])
        key = mix(s.before(o)[order[ok]] + mix(run[ok].astype(np.uint64)))
        _, back = np.unique(key, return_inverse=True)
        first = np.lexsort((least[ok], back))
        head = first[np.append(True, back[first][1:] != back[first][:-1])] if len(first) else first
        model = ok[head][back]                             # the row of the smallest document of its window
        hit = least[model] < least[ok]
        mine, theirs = order[ok[hit]], order[model[hit]]
        window = slice(left - o, left - o + span)
        if not (rows[mine, window] == rows[theirs, window]).all():
            raise Collision
        out[mine] |= np.uint32(1 << o)
    return out


def row_hash(rows: np.ndarray, seed: int) -> np.ndarray:
    up = np.random.default_rng(seed + 1000).integers(1, 2**63, rows.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    table, total = byte_values(seed=seed), np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        total += table[rows[:, k]] * up[k]
    return mix(total)
