"""Suffix arrays by linear grouping construction.

Phase 1 groups suffixes by their longest Lyndon prefix. Groups start as the classes of
first symbols and are visited in descending order. When a group is visited it is final;
for each of its suffixes i the previous-smaller pointer leads to the closest suffix left
of i in a lower group, by jumping over suffixes whose own pointers are known. The suffixes
pointed to have a Lyndon prefix that goes on with this group's: within their groups, those
with more such continuations move behind those with fewer. Everything a group needs has
been decided by greater groups, so no group is visited twice.

Phase 2 emits the order. A suffix i is its Lyndon prefix followed by the suffix where that
prefix ends, and this one is smaller; so going through the suffix array from the front (the
empty suffix first) and dropping every suffix that ends there into the next free place of
its group sorts each group, with no renaming and no recursion.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of the suffixes of a list of integers, in lexicographic order."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)  # members of a group are adjacent
    place = [0] * n
    start = [0] * n  # first place of a suffix's group
    stop: dict[int, int] = {}  # group start -> place after its last member
    first = 0
    for p, i in enumerate(order):
        place[i] = p
        if p and text[i] != text[order[p - 1]]:
            stop[first] = p
            first = p
        start[i] = first
    if n:
        stop[first] = n

    previous = [-1] * n
    end = list(range(1, n + 1))  # where the Lyndon prefix found so far ends
    high = n
    while high:
        low = start[order[high - 1]]
        if high - low == 1:  # most groups end as one suffix
            i = order[low]
            p = i - 1
            while p >= 0 and start[p] >= low:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                end[p] = end[i]
                group = start[p]
                last = stop[group] - 1
                if last > group:
                    stop[group] = last
                    other, here = order[last], place[p]
                    order[here], order[last] = other, p
                    place[other], place[p] = here, last
                    start[p] = last
                    stop[last] = last + 1
            high = low
            continue
        members = order[low:high]
        members.sort()
        count: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and start[p] >= low:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                count[p] = count.get(p, 0) + 1
                end[p] = end[i]
        if not count or max(count.values()) == 1:
            levels = [list(count)]
        else:
            by_count: dict[int, list[int]] = {}
            for p, c in count.items():
                by_count.setdefault(c, []).append(p)
            levels = [by_count[c] for c in sorted(by_count, reverse=True)]
        for parents in levels:  # most continuations first: they go to the very end
            top: dict[int, int] = {}
            for p in parents:
                group = start[p]
                last = stop[group]
                if group not in top:
                    top[group] = last
                last -= 1
                stop[group] = last
                other, here = order[last], place[p]
                order[here], order[last] = other, p
                place[other], place[p] = here, last
            for p in parents:
                start[p] = stop[start[p]]
            for group, after in top.items():
                stop[stop[group]] = after
        high = low

    following: list[int] = [-1] * (n + 1)  # suffixes whose Lyndon prefix ends at a place, as chains
    link = [-1] * n
    for i in range(n):
        link[i] = following[end[i]]
        following[end[i]] = i
    result = [0] * n
    free = {}
    j = n
    for r in range(n + 1):
        i = following[j]
        while i >= 0:
            group = start[i]
            at = free.get(group, group)
            result[at] = i
            free[group] = at + 1
            i = link[i]
        if r < n:
            j = result[r]
    return result
