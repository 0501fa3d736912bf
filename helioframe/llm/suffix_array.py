"""Linear suffix sorting by grouping, without recursive renaming.

Suffixes are grouped by their Lyndon prefix. Groups are handled from the
greatest to the least: each suffix of a group follows previous-smaller
pointers to the nearest suffix on its left that is in a lesser group, and
those parents are told apart by how many suffixes of the group they got; more
means greater. When all groups are final they stand in order, and one pass
from the least suffix to the greatest puts the suffixes that end where the
current one begins into the next free places of their groups.
"""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes of ``symbols`` (not negative) in ascending order; the end is less than any symbol."""
    groups, parent = _lyndon_groups(symbols)
    return _emitted(groups, parent)


def _lyndon_groups(symbols: list[int]) -> tuple[list[int], list[int]]:
    """For each suffix, where its group begins in the suffix array, and its previous smaller suffix (-1: none)."""
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    begin = 0
    for k, i in enumerate(order):
        place[i] = k
        if symbols[i] != symbols[order[begin]]:
            begin = k
        group[i] = begin
        size[begin] = k - begin + 1
    parent, done = [-1] * n, bytearray(n)
    end = n
    while end:
        i = order[end - 1]
        begin = group[i]
        if begin == end - 1:  # a group of one: its parent alone moves to the back
            end = begin
            done[i] = 1
            p = i - 1
            while p >= 0 and done[p]:
                p = parent[p]
            parent[i] = p
            if p >= 0:
                g = group[p]
                last = size[g] - 1
                if last:
                    size[g] = last
                    last += g
                    size[last] = 1
                    k, other = place[p], order[last]
                    order[last], order[k] = p, other
                    place[p], place[other] = last, k
                    group[p] = last
            continue
        members = sorted(order[begin:end])
        end = begin
        for i in members:
            done[i] = 1
        hits: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and done[p]:
                p = parent[p]
            parent[i] = p
            if p >= 0:
                hits[p] = hits.get(p, 0) + 1
        # Parents move to the back of their group, those with most hits first.
        if not hits:
            continue
        by_hits: dict[int, list[int]] = {}
        for p, c in hits.items():
            by_hits.setdefault(c, []).append(p)
        for c in sorted(by_hits, reverse=True):
            moved: dict[int, int] = {}
            for p in by_hits[c]:
                g = group[p]
                m = moved[g] = moved.get(g, 0) + 1
                k, to = place[p], g + size[g] - m
                other = order[to]
                order[to], order[k] = p, other
                place[p], place[other] = to, k
            for g, m in moved.items():
                if m < size[g]:
                    size[g] -= m
                    new = g + size[g]
                    size[new] = m
                    for p in order[new:new + m]:
                        group[p] = new
    return group, parent


def _emitted(group: list[int], parent: list[int]) -> list[int]:
    n = len(group)
    out, free, placed = [0] * n, list(range(n)), bytearray(n)
    i, k = n, 0
    while True:
        p = i - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            at = free[g]
            out[at] = p
            free[g] = at + 1
            placed[p] = 1
            p = parent[p]
        if k == n:
            return out
        i = out[k]
        k += 1
