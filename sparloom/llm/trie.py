"""Binary tries of fingerprints joined with themselves.

Node pairs are walked together; the bits they differ in add up, and a pair is
dropped once they exceed the budget.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: A node of so few fingerprints isn't split.
LEAF = 48


class Forest:
    """Union-find over a bucket's positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def trie_join(values: list[int], budget: int = 2) -> list[tuple[int, int]]:
    """Spanning links among sorted distinct ``values`` within ``budget`` differing bits.

    A trie node is a range of the sorted array with its common bits; children
    part at the next bit that differs within the range.  Pairs of nodes are
    walked together with the bits they already differ in.
    """
    forest, links = Forest(len(values)), []

    def split(lo: int, hi: int) -> tuple[int, int]:
        """(bit below which the range's values may differ, where the upper half begins)."""
        bit = (values[lo] ^ values[hi - 1]).bit_length()
        if not bit:
            return 0, hi
        pivot = (values[hi - 1] >> (bit - 1)) << (bit - 1)
        a, b = lo, hi
        while a < b:
            m = (a + b) // 2
            if values[m] < pivot:
                a = m + 1
            else:
                b = m
        return bit, a

    def same(lo: int, hi: int) -> None:
        stack = [(lo, hi)]
        while stack:
            lo, hi = stack.pop()
            if hi - lo < 2:
                continue
            _, mid = split(lo, hi)
            pair(lo, mid, mid, hi)
            stack += [(lo, mid), (mid, hi)]

    def pair(a: int, b: int, x: int, y: int) -> None:
        stack = [(a, b, x, y)]
        while stack:
            a, b, x, y = stack.pop()
            bit_l, mid_l = split(a, b)
            bit_r, mid_r = split(x, y)
            bit = max(bit_l, bit_r)
            if ((values[a] ^ values[x]) >> bit).bit_count() > budget:
                continue
            if not bit:
                if forest.join(a, x):
                    links.append((values[a], values[x]))
            elif bit_l >= bit_r:
                stack += [(a, mid_l, x, y), (mid_l, b, x, y)]
            else:
                stack += [(a, b, x, mid_r), (a, b, mid_r, y)]

    same(0, len(values))
    return links


def trie_pairs(prints: np.ndarray, budget: int, root: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (rows, rows) of wide ``prints`` (n, words) within ``budget`` differing bits and of different ``root``.

    Eight levels of the trie are descended at a time: a node's children are the values of
    the next byte, and all node pairs of a depth go down together.  Nodes whose fingerprints
    all have one root, the same, are dropped too.
    """
    raw = prints.astype(">u8").view(np.uint8).reshape(len(prints), -1)
    order = np.lexsort(raw.T[::-1])
    raw, words, root = raw[order], prints[order], root[order]
    n, wide = raw.shape

    def compared(a, b):
        """Leaves (ranges of rows) against each other."""
        for (lo, hi), (x, y) in zip(a, b):
            one = np.repeat(np.arange(lo, hi), y - x)
            two = np.tile(np.arange(x, y), hi - lo)
            if lo == x:
                ok = one < two
                one, two = one[ok], two[ok]
            ok = root[one] != root[two]
            one, two = one[ok], two[ok]
            ok = np.bitwise_count(words[one] ^ words[two]).sum(axis=1) <= budget
            if ok.any():
                yield order[one[ok]], order[two[ok]]

    begin, end = np.zeros(1, np.int64), np.full(1, n)
    a = b = np.zeros(1, np.int64)
    far = np.zeros(1, np.int64)
    for depth in range(wide + 1):
        least, most = np.minimum.reduceat(root, begin), np.maximum.reduceat(root, begin)
        size = end - begin
        ok = (far <= budget) & ~((least[a] == most[a]) & (least[b] == most[b]) & (least[a] == least[b]))
        a, b, far = a[ok], b[ok], far[ok]
        leaf = (size[a] * size[b] <= LEAF * LEAF) | (depth == wide)
        nodes = np.stack([begin, end], axis=1)
        yield from compared(nodes[a[leaf]].tolist(), nodes[b[leaf]].tolist())
        a, b, far = a[~leaf], b[~leaf], far[~leaf]
        if not len(a):
            return
        new = np.zeros(n, bool)
        new[begin] = True
        new[1:] |= raw[1:, depth] != raw[:-1, depth]
        below = np.flatnonzero(new)
        first = np.searchsorted(below, begin)  # a node's first child
        kids = np.append(first[1:], len(below)) - first
        byte = raw[below, depth]
        times = kids[a] * kids[b]
        pair = np.repeat(np.arange(len(a)), times)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
        x, y = first[a[pair]] + place // kids[b[pair]], first[b[pair]] + place % kids[b[pair]]
        ok = (a[pair] != b[pair]) | (x <= y)
        x, y, pair = x[ok], y[ok], pair[ok]
        a, b, far = x, y, far[pair] + np.bitwise_count(byte[x] ^ byte[y])
        begin, end = below, np.append(below[1:], n)
