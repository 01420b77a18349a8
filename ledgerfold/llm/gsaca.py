"""Suffix arrays by linear grouping: first all suffixes are put into groups by their Lyndon prefix, taking groups in
descending order; then the order within each group is emitted from left to right.  No recursion, no renaming."""

from __future__ import annotations

import numpy as np


def grouped(x: list[int]) -> tuple[list[int], list[int]]:
    """(group, smaller): the place at which each suffix's group starts, and the nearest suffix to its left that is in a
    lower group (-1: none).  x ends in a symbol smaller than all others."""
    n = len(x)
    slots = np.argsort(np.asarray(x), kind="stable")
    ranked = np.asarray(x)[slots]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    heads = np.repeat(first, np.diff(np.append(first, n)))
    head_of = np.empty(n, np.int64)
    head_of[slots] = heads
    group, slot_of = head_of.tolist(), np.empty(n, np.int64)
    slot_of[slots] = np.arange(n)
    where, slots = slot_of.tolist(), slots.tolist()
    size = dict(zip(first.tolist(), np.diff(np.append(first, n)).tolist()))
    smaller = [-1] * n
    top = n
    while top:
        low = group[slots[top - 1]]
        members = slots[low:top] if top - low == 1 else sorted(slots[low:top])
        times: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        top = low
        # those preceding more of this group's words come after their old group first, so they end up higher
        if len(times) > 1:
            by_times: dict[int, list[int]] = {}
            for j, t in times.items():
                by_times.setdefault(t, []).append(j)
            waves = [by_times[t] for t in sorted(by_times, reverse=True)]
        else:
            waves = [list(times)]
        for wave in waves:
            ends: dict[int, int] = {}
            for j in wave:  # each moves to the end of what is left of its group
                g = group[j]
                end = ends.get(g)
                if end is None:
                    end = g + size[g]
                end -= 1
                ends[g] = end
                other, at = slots[end], where[j]
                slots[at], where[other] = other, at
                slots[end], where[j] = j, end
            for g, end in ends.items():
                if end > g:
                    size[end] = g + size[g] - end
                    size[g] = end - g
                    for k in range(end, end + size[end]):
                        group[slots[k]] = end
    return group, smaller


def suffix_array(x: list[int]) -> list[int]:
    """The starts of all suffixes of x in order; x ends in a symbol smaller than all others."""
    group, smaller = grouped(x)
    n = len(x)
    free = list(range(n + 1))
    out, placed = [0] * n, [False] * n
    out[0], placed[n - 1] = n - 1, True
    free[group[n - 1]] += 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = smaller[j]
    return out
