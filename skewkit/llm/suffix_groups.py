"""Linear grouping construction of a suffix array over integer symbols.

Suffixes are grouped by their Lyndon prefix, the longest Lyndon word they begin
with. Groups are taken in descending order: each member finds its previous
smaller suffix, and every suffix so pointed to has its prefix extended by the group's,
so it moves to a new group right behind its old one. Once all groups are
final, one pass over the array emits the order of each group; nothing is renamed
and there is no recursion.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of ``symbols`` (non-negative integers) in lexicographic order; a shorter prefix sorts first."""
    if len(symbols) == 0:
        return np.zeros(0, dtype=np.int64)
    text = np.concatenate((np.asarray(symbols, dtype=np.int64) + 1, [0]))  # a unique least symbol ends the text
    n = len(text)
    order = np.argsort(text, kind="stable")
    first = np.concatenate(([True], text[order][1:] != text[order][:-1]))
    starts = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    group = np.empty(n, dtype=np.int64)
    group[order] = starts
    ends = np.flatnonzero(np.concatenate((first[1:], [True]))) + 1
    size = dict(zip(np.flatnonzero(first).tolist(), (ends - np.flatnonzero(first)).tolist(), strict=True))
    at, pos, grp = order.tolist(), place.tolist(), group.tolist()
    previous = [-1] * n  # the nearest position to the left in a lower group
    jump = [-1] * n  # the same, shortened as lower groups come up

    end = n
    while end > 0:
        start = grp[at[end - 1]]
        pointed: dict[int, int] = {}
        for m in sorted(at[start:end]) if end - start > 1 else at[start:end]:
            j = m - 1
            walked = []
            while j >= 0 and grp[j] >= start:
                walked.append(j)
                j = jump[j]
            for w in walked:
                jump[w] = j
            previous[m] = jump[m] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        end = start
        if not pointed:
            continue
        by_count: dict[int, dict[int, list[int]]] = {}
        for j, times in pointed.items():
            by_count.setdefault(times, {}).setdefault(grp[j], []).append(j)
        for times in sorted(by_count, reverse=True):
            for old, members in by_count[times].items():
                if len(members) == size[old]:
                    continue  # the whole group moves: it keeps its place
                stop = old + size[old]
                new = stop - len(members)
                for k, j in enumerate(members):
                    if pos[j] < new:  # trade places with a suffix that stays, taken from the end of the group
                        continue
                    members[k] = -1 - j
                free = [q for q in range(new, stop) if grp[at[q]] == old and pointed.get(at[q]) != times]
                for j in members:
                    if j >= 0:
                        q = free.pop()
                        stays, p = at[q], pos[j]
                        at[q], at[p], pos[j], pos[stays] = j, stays, q, p
                for q in range(new, stop):
                    grp[at[q]] = new
                size[new], size[old] = len(members), size[old] - len(members)

    filled = [-1] * n
    filled[0] = n - 1
    slot = {}
    placed = [False] * n
    for i in range(n):
        j = filled[i] - 1
        while j >= 0 and not placed[j]:
            g = grp[j]
            q = slot.get(g, g)
            slot[g] = q + 1
            filled[q] = j
            placed[j] = True
            j = previous[j]
    return np.array(filled[1:], dtype=np.int64)
