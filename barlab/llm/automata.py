"""Grammar inference: probabilistic automata from sample strings by state merging.

The strings form a prefix tree whose states count how often they are passed, left by each symbol and ended in.
States whose futures are statistically alike (Hoeffding's bound, checked down the tree) are merged, the most
frequent first, until every state is either a state of the automaton or part of one.
"""
from __future__ import annotations

import math
from collections import deque

ALIKE = 0.05  # confidence of the bound
ENOUGH = 12  # states passed less often are not told apart


class Automaton:
    def __init__(self, symbols: str):
        self.symbols = symbols
        self.passed, self.ended, self.moves = [0], [0], [{}]
        self.flat: list | None = None

    def add(self, text: str, times: int = 1) -> None:
        at = 0
        self.passed[0] += times
        for c in text:
            if c not in self.moves[at]:
                self.moves[at][c] = [len(self.passed), 0]
                self.passed.append(0)
                self.ended.append(0)
                self.moves.append({})
            step = self.moves[at][c]
            step[1] += times
            at = step[0]
            self.passed[at] += times
        self.ended[at] += times

    def _alike(self, a: int, b: int) -> bool:
        queue = [(a, b)]
        while queue:
            a, b = queue.pop()
            n, m = self.passed[a], self.passed[b]
            if n < ENOUGH or m < ENOUGH:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALIKE)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ended[a] / n - self.ended[b] / m) > bound:
                return False
            for c in {*self.moves[a], *self.moves[b]}:
                x, y = self.moves[a].get(c), self.moves[b].get(c)
                if abs((x[1] if x else 0) / n - (y[1] if y else 0) / m) > bound:
                    return False
                if x and y and x[0] != y[0]:
                    queue.append((x[0], y[0]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        queue = [(into, tree)]
        while queue:
            a, b = queue.pop()
            self.passed[a] += self.passed[b]
            self.ended[a] += self.ended[b]
            for c, (child, n) in self.moves[b].items():
                if c in self.moves[a]:
                    self.moves[a][c][1] += n
                    queue.append((self.moves[a][c][0], child))
                else:
                    self.moves[a][c] = [child, n]

    def merge(self) -> "Automaton":
        """Merge the tree into an automaton."""
        red, seen = [0], {0}
        blue = deque()

        def frontier():
            return [(self.passed[t], s, c, t) for s in red for c, (t, _) in self.moves[s].items() if t not in seen]

        blue = frontier()
        while blue:
            _, s, c, t = max(blue)
            for r in red:
                if self._alike(r, t):
                    self.moves[s][c][0] = r
                    self._fold(r, t)
                    break
            else:
                red.append(t)
                seen.add(t)
            blue = frontier()
        index = {s: i for i, s in enumerate(red)}
        kinds = len(self.symbols) + 1
        self.flat = []
        for s in red:
            total = self.passed[s] + 0.5 * kinds
            steps = {c: (index[t], math.log((n + 0.5) / total)) for c, (t, n) in self.moves[s].items()}
            self.flat.append((steps, math.log((self.ended[s] + 0.5) / total), math.log(0.5 / total)))
        return self

    def score(self, text: str) -> float:
        """Log probability; a symbol never seen in a state costs the smoothing share and stays there."""
        at, total = 0, 0.0
        for c in text:
            steps, _, other = self.flat[at]
            step = steps.get(c)
            if step is None:
                total += other
            else:
                at = step[0]
                total += step[1]
        return total + self.flat[at][1]
