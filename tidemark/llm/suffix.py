"""Suffix order by the linear grouping construction (Baier, CPM 2016).

Suffixes are grouped by their first symbol. Groups are then processed in
descending order: every member looks up its previous smaller suffix (the
nearest one to the left in a lower group) by following pointers, and the
suffixes pointed to move, by how often they are pointed to, into new groups
right after the rest of their own. At the end each group holds the suffixes
with one Lyndon prefix. A last ascending pass puts the suffixes in order; no
names are given anew and nothing recurses.
"""

from __future__ import annotations


def suffix_order(symbols: list[int]) -> list[int]:
    """Starts of all suffixes in ascending order; the last symbol must be the only smallest one."""
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)  # stable: ascending starts in each group
    place = [0] * n
    group = [0] * n  # a group is named by its first place in `order`
    ends = [0] * n  # by group
    at = 0
    for i, s in enumerate(order):
        if symbols[s] != symbols[order[at]]:
            ends[at] = i
            at = i
        group[s] = at
        place[s] = i
    if n:
        ends[at] = n
    smaller = [-1] * n
    end = n
    while end > 0:
        g = group[order[end - 1]]
        if end - g == 1:
            s = order[g]
            p = s - 1
            while p >= 0 and group[p] >= g:
                p = smaller[p]
            smaller[s] = p
            if p >= 0:
                split(group[p], (p,), order, place, group, ends)
        else:
            times: dict[int, int] = {}
            for s in sorted(order[g:end]):
                p = s - 1
                while p >= 0 and group[p] >= g:
                    p = smaller[p]
                smaller[s] = p
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            moved: dict[tuple[int, int], list[int]] = {}
            for p, k in times.items():
                moved.setdefault((-k, group[p]), []).append(p)
            for key in sorted(moved):  # the most often pointed to go last in their group
                split(key[1], moved[key], order, place, group, ends)
        end = g
    return emit(order, group, smaller)


def split(q: int, part, order: list[int], place: list[int], group: list[int], ends: list[int]) -> None:
    """Makes `part` of group `q` a group of its own, right after the rest; nothing to do if it is all of it."""
    end = ends[q]
    if end - q == len(part):
        return
    to = end
    for p in part:
        to -= 1
        i, other = place[p], order[to]
        order[i], place[other] = other, i
        order[to], place[p] = p, to
    for p in part:
        group[p] = to
    ends[q], ends[to] = to, end


def emit(order: list[int], group: list[int], smaller: list[int]) -> list[int]:
    """The order from the groups: each suffix found places the one before it and that one's smaller ones."""
    n = len(order)
    out = [-1] * n
    if not n:
        return out
    front = list(range(n))
    done = bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    front[0] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[front[g]] = s
            front[g] += 1
            done[s] = 1
            s = smaller[s]
    return out
