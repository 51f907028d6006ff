"""Linear grouping construction of suffix arrays.

Suffixes start in groups by first symbol. Groups are taken from the largest to the smallest; each member points to the nearest
suffix before it that lies in a smaller group, and the suffixes pointed to move to a new group just above their own, those
with more pointers higher. In the end a group holds the suffixes with one longest Lyndon prefix. A second pass then emits
every group's order, following the same pointers from suffixes already placed, without naming or sorting anything again.
"""

from __future__ import annotations


def suffix_order(symbols: list[int]) -> list[int]:
    """The suffixes of a sequence of positive numbers in ascending order, a shorter one before those it begins."""
    text = [*symbols, 0]
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size, before = [0] * n, [0] * n, [0] * n, [-2] * n  # -2: not known yet
    start = 0
    for i, s in enumerate(order):
        if text[s] != text[order[start]]:
            start = i
        place[s], group[s] = i, start
        size[start] += 1

    last = n - 1
    while last > 0:
        own = group[order[last]]
        pointed: dict[int, int] = {}
        for s in order[own:last + 1]:
            p = s - 1
            while p >= 0 and group[p] >= own:
                p = before[p] if before[p] != -2 else p - 1
            before[s] = p
        for s in order[own:last + 1]:
            p = before[s]
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            levels: dict[int, list[int]] = {}
            for p, times in pointed.items():
                levels.setdefault(times, []).append(p)
            for times in sorted(levels, reverse=True):
                moved: dict[int, int] = {}
                for p in levels[times]:
                    g = group[p]
                    moved[g] = moved.get(g, 0) + 1
                    to = g + size[g] - moved[g]
                    other, at = order[to], place[p]
                    order[at], order[to] = other, p
                    place[other], place[p] = at, to
                for g, k in moved.items():
                    rest = size[g] - k
                    if rest:
                        new = g + rest
                        size[g], size[new] = rest, k
                        for s in order[new:new + k]:
                            group[s] = new
        last = own - 1

    out, done = [0] * n, [False] * n
    out[0], done[n - 1] = n - 1, True
    head = list(range(n))  # next free place of the group that starts there
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[head[g]] = s
            head[g] += 1
            done[s] = True
            s = before[s]
    return out[1:]
