"""Merging sorted runs of byte strings with a loser tree that never compares a known common prefix again."""

from __future__ import annotations


def _compare(a: bytes, b: bytes, known: int) -> tuple:
    """(a is not greater, length of the common prefix), given that `known` bytes are equal."""
    n = min(len(a), len(b))
    while known < n and a[known] == b[known]:
        known += 1
    if known == n:
        return len(a) <= len(b), n
    return a[known] < b[known], known


def merge(runs: list, prefixes: list) -> tuple:
    """(run, lcp) of the merged order: which run each next string comes from, and what it shares with the one before.

    `runs` are sorted lists of bytes, `prefixes` the shared length of each string with the one before it in
    its run. Ties go to the earlier run. A tree node holds the loser of a match and the length it shares
    with the winner; as all on the winner's path are compared with the same last output, the longer
    known prefix wins without a look at the bytes.
    """
    size = 1
    while size < len(runs):
        size *= 2
    at = [0] * size
    head: list = [r[0] if r else None for r in runs] + [None] * (size - len(runs))
    share = [0] * size                 # what a run's head shares with the last output
    loser, winner = [0] * size, list(range(size))

    def match(a: int, b: int) -> tuple:
        """(winner, loser); the loser's share becomes what it has in common with the winner."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None and (y is not None or b < a) else (a, b)
        if share[a] != share[b]:
            return (a, b) if share[a] > share[b] else (b, a)
        if a > b:
            a, b, x, y = b, a, y, x
        first, common = _compare(x, y, share[a])
        if not first:
            a, b = b, a
        share[b] = common
        return a, b

    level = winner
    base = size
    while len(level) > 1:              # first round: nothing is known, shares are those between the two
        base //= 2
        nexts = []
        for i in range(0, len(level), 2):
            share[level[i]] = share[level[i + 1]] = 0
            won, lost = match(level[i], level[i + 1])
            loser[base + i // 2] = lost
            nexts.append(won)
        level = nexts
    best = level[0]
    order, lcps = [], []
    share[best] = 0
    while head[best] is not None:
        order.append(best)
        lcps.append(share[best])
        at[best] += 1
        i = at[best]
        run = runs[best]
        if i < len(run):
            head[best], share[best] = run[i], prefixes[best][i]
        else:
            head[best] = None
        node = (size + best) // 2
        while node:
            best, loser[node] = match(best, loser[node])
            node //= 2
    return order, lcps
