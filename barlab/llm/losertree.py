"""Merging of front-coded sorted runs with a loser tree that knows common prefixes.

A run is a list of strings, each given by how many bytes it shares with the one before and by the rest. Every
string waiting in the tree carries the length of the prefix it shares with the last string put out. Of two
waiting strings the one that shares more comes first, with no byte looked at; if they share equally much they
are compared from there on. So bytes known to be equal are never compared again. (The published LCP loser tree.)
"""
from __future__ import annotations


def merge(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[int], list[int]]:
    """Merge runs of (shared lengths, rests).

    Returns the run each string of the merged order came from, and how many bytes it shares with the one before
    it in that order. Equal strings come by run, then by place in the run.
    """
    filled = [r for r, (shared, _) in enumerate(runs) if shared]
    if not filled:
        return [], []
    if len(filled) == 1:
        only = filled[0]
        return [only] * len(runs[only][0]), [0, *runs[only][0][1:]]
    size = 1
    while size < len(runs):
        size *= 2
    text: list[bytes | None] = [None] * size  # the string waiting in each run; None: run out
    known = [0] * size  # bytes it shares with the last string put out
    at = [0] * size
    for r in filled:
        text[r] = runs[r][1][0]

    def first(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs; the loser's shared length becomes that with the winner."""
        x, y = text[a], text[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = known[a], known[b]
        if p > q:
            return a, b
        if q > p:
            return b, a
        n = min(len(x), len(y))
        while p < n and x[p] == y[p]:
            p += 1
        if p == len(x) and (p < len(y) or a < b) or p < n and x[p] < y[p] or p == len(x) == len(y) and a < b:
            known[b] = p
            return a, b
        known[a] = p
        return b, a

    loser = [0] * size
    winner = [0] * (2 * size)
    winner[size:] = range(size)
    for node in range(size - 1, 0, -1):
        winner[node], loser[node] = first(winner[2 * node], winner[2 * node + 1])
    top = winner[1]
    order, shared_out = [], []
    leaves = size
    while text[top] is not None:
        order.append(top)
        shared_out.append(known[top])
        shared, rest = runs[top]
        i = at[top] = at[top] + 1
        if i < len(shared):
            p = shared[i]
            text[top] = text[top][:p] + rest[i]
            known[top] = p
        else:
            text[top] = None
        node = (leaves + top) // 2
        while node:
            other = loser[node]
            y = text[other]
            if y is not None:
                x = text[top]
                if x is None:
                    loser[node], top = top, other
                else:
                    p, q = known[top], known[other]
                    if p == q:
                        n = len(x) if len(x) < len(y) else len(y)
                        while p < n and x[p] == y[p]:
                            p += 1
                        if p < n:
                            less = x[p] < y[p]
                        else:
                            less = len(x) < len(y) or (len(x) == len(y) and top < other)
                        if less:
                            known[other] = p
                        else:
                            known[top] = p
                            loser[node], top = top, other
                    elif q > p:
                        loser[node], top = top, other
            node //= 2
    shared_out[0] = 0
    return order, shared_out
