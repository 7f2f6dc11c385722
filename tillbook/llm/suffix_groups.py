"""Suffix sorting by grouping: linear, without recursive renaming of the text.

First suffixes are grouped by their longest Lyndon prefix. Groups start as those of equal first symbols and are taken
from the largest down. Each suffix of the group at hand points to the previous smaller suffix: the nearest one before it
whose group is still to come. That one's Lyndon prefix goes on with the group's, so it moves to a group right above its
old one, those pointed to more often further up. Then the order is emitted: the groups' places are known by now, and going
through the order from the smallest, the suffixes before each one, along the pointers, take the next place of their
groups.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_order(text: Sequence[int]) -> list[int]:
    """Starts of all suffixes of ``text`` in ascending order; a suffix comes before those it is a prefix of."""
    n = len(text)
    by_symbol: dict[int, list[int]] = {}
    for at, symbol in enumerate(text):
        by_symbol.setdefault(symbol, []).append(at)
    members = [by_symbol[symbol] for symbol in sorted(by_symbol)]
    below = list(range(-1, len(members) - 1))  # the neighbours of a group in order
    above = list(range(1, len(members) + 1))
    group = [0] * n
    for number, starts in enumerate(members):
        for at in starts:
            group[at] = number
    size = [len(starts) for starts in members]
    up = list(range(-1, n))  # at p + 1: p itself while its group is still to come, else some position before it
    previous = [-1] * n
    done: list[list[int]] = []

    def rise(starts: list[int], old: int) -> None:
        """Move suffixes to a group right above their old one; all that are left in it may as well stay."""
        if len(starts) == size[old]:
            return
        number, over = len(members), above[old]
        members.append(starts)
        size.append(len(starts))
        size[old] -= len(starts)
        below.append(old)
        above.append(over)
        below[over] = above[old] = number
        for p in starts:
            group[p] = number

    top = len(members) - 1
    while top >= 0:
        here = members[top]
        if size[top] != len(here):
            here = [at for at in here if group[at] == top]
        done.append(here)
        for at in here:
            up[at + 1] = at - 1
        if len(here) == 1:
            p = at - 1
            while up[p + 1] != p:
                up[p + 1] = p = up[up[p + 1] + 1]
            previous[at] = p
            if p >= 0 and size[old := group[p]] > 1:  # as rise() does, for one
                number, over = len(members), above[old]
                members.append([p])
                size.append(1)
                size[old] -= 1
                below.append(old)
                above.append(over)
                below[over] = above[old] = group[p] = number
            top = below[top]
            continue
        pointed: dict[int, int] = {}
        for at in here:
            p = at - 1
            while up[p + 1] != p:
                up[p + 1] = p = up[up[p + 1] + 1]
            previous[at] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for p, times in pointed.items():
            moves.setdefault((-times, group[p]), []).append(p)
        for times, old in sorted(moves) if len(moves) > 1 else moves:  # what is pointed to more often ends up higher
            rise(moves[times, old], old)
        top = below[top]
    return _emitted(n, done, group, previous, len(members))


def _emitted(n: int, done: list[list[int]], group: list[int], previous: list[int], groups: int) -> list[int]:
    """The order, given the groups from the largest down and the pointers to previous smaller suffixes."""
    place, at = [0] * groups, n
    for starts in done:
        at -= len(starts)
        place[group[starts[0]]] = at
    order, waiting = [-1] * n, [True] * n
    for i in range(-1, n):
        p = (order[i] if i >= 0 else n) - 1
        while p >= 0 and waiting[p]:
            own = group[p]
            order[place[own]] = p
            place[own] += 1
            waiting[p] = False
            p = previous[p]
    return order
