"""Suffix arrays of a shard of strings of bytes, or of 64-bit codes, in numpy."""

from __future__ import annotations

import numpy as np


def ordered(group: np.ndarray, then: np.ndarray, last: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): places sorted by group, then, last (each from 0, the latter two under ``most``), and which differ from the one before.

    They are sorted as one number where 63 bits hold them.
    """
    bits = most.bit_length()
    if int(group[-1]).bit_length() + 2 * bits < 64:
        one = group.astype(np.int64)
        for rank in (then, last):
            one <<= bits
            one |= rank
        order = np.argsort(one, kind="stable")
        one = one.take(order)
        return order, np.append(True, one[1:] != one[:-1])
    order = np.lexsort((last, then, group))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in (group, then, last)])
    return order, new


class Shard:
    """The strings of a shard end to end; no comparison runs past a string's end, which sorts before any symbol.

    A symbol is a byte (``unit`` 1), or a code of 8 bytes, known by its rank in the shard.
    """

    def __init__(self, strings: list[bytes], unit: int = 1):
        self.size = np.fromiter(map(len, strings), np.int64, len(strings)) // unit
        self.start = np.cumsum(self.size) - self.size
        data, kinds = np.frombuffer(b"".join(strings), np.uint8), 256
        if unit > 1:
            codes, data = np.unique(data.view("<u8"), return_inverse=True)
            kinds = len(codes)
        bits = max(kinds, 1).bit_length()
        self.first = min(7, 63 // bits)  # symbols in a sort key, the end of a string being one
        self.n = len(data)
        self.place = np.int32 if self.n < 1 << 30 else np.int64  # of a suffix, or a number up to twice as large
        self.data = np.concatenate((data, np.zeros(self.first, data.dtype)))
        self.left = np.repeat((self.start + self.size).astype(self.place), self.size) - np.arange(self.n, dtype=self.place)  # symbols to the string's end
        self.key = np.zeros(self.n, np.int64)  # the next symbols
        for k in range(self.first):
            self.key <<= bits
            self.key += (self.left > k) * (self.data[k:k + self.n] + np.int64(1))

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array, and the rank of each suffix; equal suffixes of two strings are ordered by place.

        Larsson-Sadakane refinement: groups of suffixes that agree in their first h
        symbols are refined by the ranks of the suffixes h and 2h symbols on, which sorts them by 3h;
        groups of one are left alone.
        """
        sa = np.argsort(self.key, kind="stable").astype(self.place)
        k = self.key[sa]
        fresh = np.ones(self.n, bool)
        fresh[1:] = (k[1:] != k[:-1]) | (self.left[sa[1:]] < self.first)  # a suffix that short is alone
        del k
        rank = np.empty(self.n, self.place)
        rank[sa] = np.maximum.accumulate(np.where(fresh, np.arange(self.n, dtype=self.place), 0))
        h = self.first
        while True:
            unsorted = ~(fresh & np.append(fresh[1:], True))
            at = np.flatnonzero(unsorted).astype(self.place)
            if not len(at):
                return sa, rank
            suffix = sa[unsorted].astype(np.int64)
            left = self.left.take(suffix)
            # the group's suffixes agree in h symbols; those that end there come first, by place
            then = np.where(left > h, rank.take(suffix + h, mode="clip") + self.n, suffix)
            last = np.where(left > 2 * h, rank.take(suffix + 2 * h, mode="clip") + self.n, np.where(left > h, suffix, 0))
            order, new = ordered(np.cumsum(fresh[unsorted]), then, last, 2 * self.n)
            del then, last, left
            suffix = suffix.take(order)
            sa[unsorted] = suffix
            fresh[unsorted] = new
            rank[suffix] = np.repeat(at[new], np.diff(np.append(np.flatnonzero(new), len(at))))
            h *= 3

    def common_prefixes(self, sa: np.ndarray, rank: np.ndarray, windows: np.ndarray, depth: int) -> np.ndarray:
        """For the first ``windows[k]`` suffixes of each string k: the symbols, up to ``depth``, shared with the one sorted before it.

        Kasai's algorithm, run along all strings at once: going one symbol on in a
        string loses at most one symbol of the common prefix.
        """
        out = np.zeros(self.n, np.int32)
        lane = np.argsort(-windows, kind="stable")
        h = np.zeros(len(lane), np.int64)
        for s in range(int(windows.max(initial=0))):
            lane = lane[:np.searchsorted(-windows[lane], -s)]  # strings with a suffix s
            h = np.maximum(h[:len(lane)] - 1, 0)
            i = self.start[lane] + s
            o = rank[i]
            j = sa[np.maximum(o - 1, 0)]
            limit = np.where(o > 0, np.minimum(np.minimum(self.left[i], self.left[j]), depth), 0)
            h = np.minimum(h, limit)
            go = np.flatnonzero(h + self.first <= limit)
            while len(go):  # whole keys first
                same = self.key[i[go] + h[go]] == self.key[j[go] + h[go]]
                go = go[same]
                h[go] += self.first
                go = go[h[go] + self.first <= limit[go]]
            go = np.flatnonzero(h < limit)
            while len(go):
                go = go[self.data[i[go] + h[go]] == self.data[j[go] + h[go]]]
                h[go] += 1
                go = go[h[go] < limit[go]]
            out[i] = h
        return out


def repeated_windows(strings: list[bytes], length: int, unit: int = 1) -> list[np.ndarray]:
    """For each string, which of its windows of ``length`` symbols stand elsewhere in the shard as well (or elsewhere in it)."""
    shard = Shard(strings, unit)
    windows = np.maximum(shard.size - length + 1, 0)
    sa, rank = shard.sorted()
    common = shard.common_prefixes(sa, rank, windows, length)
    found = common >= length
    hit = np.flatnonzero(found)
    found[sa[rank[hit] - 1]] = True
    return [found[a:a + w] for a, w in zip(shard.start, windows)]
