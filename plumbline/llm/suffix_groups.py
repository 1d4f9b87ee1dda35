"""Suffix sorting by groups of equal Lyndon prefixes, without renaming and without recursion.

The Lyndon prefix of a suffix is the longest Lyndon word that it begins with.  A
suffix i begins with its first symbol, followed by the Lyndon prefixes of its
children: the suffixes whose nearest smaller suffix to the left is i.

First phase.  Suffixes are grouped by first symbol.  Groups are visited from the
greatest to the least.  When a group is visited its prefix is final, and each of
its suffixes finds, by following pointers to previous smaller suffixes, the nearest
one to the left that lies in a lower group: its parent.  Parents continue with the
group's prefix as often as they have children in the group.  Among the members of
one group, those that continue more often come later, and behind those that don't
continue; so each group with parents is split, the greater part behind.

Second phase.  The groups are in their final order and only the order within each
is open.  The text's end is the first suffix.  Suffixes are taken in their final
order; the one just left of a suffix taken, and its chain of previous smaller
suffixes as far as they have no place yet, take the next free places of their
groups.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of all suffixes in order.  The last symbol must be 0 and smaller than all others."""
    n = len(symbols)
    if n < 2:
        return list(range(n))
    values = np.asarray(symbols)
    order_of = np.argsort(values, kind="stable")
    ranked = values[order_of]
    begins = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    sizes = np.diff(np.append(begins, n))
    order = order_of.tolist()  # suffixes, group by group
    place = np.empty(n, np.int64)
    place[order_of] = np.arange(n)
    place = place.tolist()
    group = np.empty(n, np.int64)  # a group goes by the place where it begins
    group[order_of] = np.repeat(begins, sizes)
    group = group.tolist()
    size = dict(zip(begins.tolist(), sizes.tolist(), strict=True))
    smaller = [-1] * n

    end = n
    while end:
        start = group[order[end - 1]]
        # Parents of the group's suffixes, and how many children each has here.
        children: dict[int, int] = {}
        if end - start == 1:
            s = order[start]
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = smaller[p]
            smaller[s] = p
            if p >= 0:
                children[p] = 1
        else:
            for s in sorted(order[start:end]):
                p = s - 1
                while p >= 0 and group[p] >= start:
                    p = smaller[p]
                smaller[s] = p
                if p >= 0:
                    children[p] = children.get(p, 0) + 1
        end = start
        if not children:
            continue
        if len(children) == 1:
            levels = (tuple(children),)
        else:
            by_count: dict[int, list[int]] = {}
            for p, times in children.items():
                by_count.setdefault(times, []).append(p)
            levels = [by_count[times] for times in sorted(by_count, reverse=True)]
        for parents in levels:
            # Members of one group that continue alike move behind the rest of it.
            moved: dict[int, int] = {}
            for p in parents:
                g = group[p]
                k = moved.get(g, 0) + 1
                moved[g] = k
                last = g + size[g] - k
                at = place[p]
                if at != last:
                    other = order[last]
                    order[at], order[last] = other, p
                    place[other], place[p] = at, last
            for g, k in moved.items():
                if k != size[g]:
                    new = g + size[g] - k
                    size[g] -= k
                    size[new] = k
                    for p in order[new : new + k]:
                        group[p] = new

    out = [0] * n
    out[0] = n - 1
    free = dict.fromkeys(size, 0)
    placed = bytearray(n)
    placed[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            k = free[g]
            out[g + k] = s
            free[g] = k + 1
            placed[s] = 1
            s = smaller[s]
    return out
