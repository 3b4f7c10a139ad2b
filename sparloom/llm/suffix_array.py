"""Suffix sorting in linear grouping steps (no recursive renaming).

Suffixes are grouped by their Lyndon prefix.  Groups are refined from the
greatest to the least: every suffix of the group at hand points to the nearest
earlier suffix of a lesser group (previous-smaller pointers, shortened as they
are followed); the suffixes pointed at leave their group for a new one right
after it, those pointed at more often further up.  A second pass from the least
suffix on fixes the order inside each group along the same pointers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Start positions of all suffixes of ``text`` (bytes or any integers) in ascending order."""
    n = len(text) + 1
    # position n - 1 is the empty suffix, least of all
    size = Counter(text)
    begin, at = {}, 1
    for symbol in sorted(size):
        begin[symbol] = at
        at += size[symbol]
    group = [begin[symbol] for symbol in text]
    group.append(0)
    order = sorted(range(n - 1), key=text.__getitem__)
    order.insert(0, n - 1)
    place = [0] * n
    for i, s in enumerate(order):
        place[s] = i
    count = [0] * (n + 1)  # members of the group that begins at an index
    count[0] = 1
    for symbol, first in begin.items():
        count[first] = size[symbol]
    before = [-1] * n
    top = n
    while top > 0:
        low = group[order[top - 1]]
        pointed: dict[int, int] = {}
        members = order[low:top] if top - low == 1 else sorted(order[low:top])
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        top = low
        if not pointed:
            continue
        if len(pointed) == 1:
            layers = ((pointed.keys()),)
        else:
            most = max(pointed.values())
            if most == 1:
                layers = (pointed.keys(),)
            else:
                by: dict[int, list[int]] = {}
                for p, times in pointed.items():
                    by.setdefault(times, []).append(p)
                layers = [by[times] for times in sorted(by, reverse=True)]
        for layer in layers:
            moved: dict[int, list[int]] = {}
            for p in layer:
                moved.setdefault(group[p], []).append(p)
            for g, leaving in moved.items():
                k = len(leaving)
                if k == count[g]:
                    continue
                end = g + count[g] - 1
                for p in leaving:
                    i, x = place[p], order[end]
                    order[i], order[end] = x, p
                    place[x], place[p] = i, end
                    end -= 1
                count[g] -= k
                fresh = end + 1
                count[fresh] = k
                for p in leaving:
                    group[p] = fresh
    front = list(range(n + 1))
    done = bytearray(n)
    sorted_ = [0] * n
    sorted_[0] = n - 1
    done[n - 1] = 1
    for i in range(n):
        s = sorted_[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            sorted_[front[g]] = s
            front[g] += 1
            done[s] = 1
            s = before[s]
    return sorted_[1:]
