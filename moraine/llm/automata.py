"""Probabilistic automata from positive examples: a prefix tree whose compatible states are merged."""

from __future__ import annotations

import heapq
import itertools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field


@dataclass
class Node:
    seen: int = 0  # examples through or ending here
    ends: int = 0
    next: dict[str, int] = field(default_factory=dict)
    took: dict[str, int] = field(default_factory=dict)


class Automaton:
    """States are numbers; each has counts of ends and of symbols taken.

    Two states are compatible when the Hoeffding bound at ``alpha`` does not tell their shares of ends and of every
    symbol apart, nor those of their successors, recursively. States of all depths may merge, so the automaton forgets lengths;
    a model of its own keeps them.
    """

    def __init__(self, strings: list[str], alpha: float = 0.01):
        self.alpha, self.nodes = alpha, [Node()]
        self.lengths, self.total = Counter(map(len, strings)), len(strings)
        #: No string with more symbols is accepted.
        self.depth = max(map(len, strings), default=0) * 8 // 7 + 1
        for s in strings:
            self._add(s)
        self._merge_all()
        rates = sorted(self.rate(s) for s in strings)
        #: Log-likelihood a symbol that 98 of 100 examples reach.
        self.floor = rates[len(rates) // 50] if rates else math.inf

    def _add(self, s: str) -> None:
        at = 0
        for c in s:
            node = self.nodes[at]
            node.seen += 1
            node.took[c] = node.took.get(c, 0) + 1
            if c not in node.next:
                node.next[c] = len(self.nodes)
                self.nodes.append(Node())
            at = node.next[c]
        self.nodes[at].seen += 1
        self.nodes[at].ends += 1

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(a / n - b / m) > math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            x, y = (self.nodes[i] for i in stack.pop())
            if self._differ(x.ends, x.seen, y.ends, y.seen):
                return False
            for c in x.took.keys() | y.took.keys():
                if self._differ(x.took.get(c, 0), x.seen, y.took.get(c, 0), y.seen):
                    return False
                if c in x.next and c in y.next:
                    stack.append((x.next[c], y.next[c]))
        return True

    def _fold(self, into: int, tree: int) -> list[int]:
        """Add the counts of a subtree to the states that its strings reach from ``into``; the states that got new successors."""
        stack, grown = [(into, tree)], []
        while stack:
            i, t = stack.pop()
            x, y = self.nodes[i], self.nodes[t]
            x.seen += y.seen
            x.ends += y.ends
            for c, n in y.took.items():
                x.took[c] = x.took.get(c, 0) + n
            for c, child in y.next.items():
                if c in x.next:
                    stack.append((x.next[c], child))
                else:
                    x.next[c] = child
                    grown.append(i)
        return grown

    def _merge_all(self) -> None:
        """Red states are final, blue ones are their other successors. The fullest blue state joins a compatible red one, the
        nearest in depth first (then the fullest), at whatever depth; without any it becomes red. So loops may arise."""
        depth, red, order = {0: 0}, [0], itertools.count()
        blue = [(-self.nodes[t].seen, next(order), 0, c, t) for c, t in sorted(self.nodes[0].next.items())]
        heapq.heapify(blue)
        while blue:
            _, _, parent, c, t = heapq.heappop(blue)
            if self.nodes[parent].next[c] != t or t in depth:
                continue
            deep = depth[parent] + 1
            for i in sorted(red, key=lambda i: (abs(depth[i] - deep), -self.nodes[i].seen, i)):
                if self._compatible(i, t):
                    self.nodes[parent].next[c] = i
                    grown = self._fold(i, t)
                    break
            else:
                depth[t] = deep
                red.append(t)
                grown = [t]
            for i in grown:
                for c, t in sorted(self.nodes[i].next.items()) if i in depth else ():
                    if t not in depth:
                        heapq.heappush(blue, (-self.nodes[t].seen, next(order), i, c, t))
        names = {old: new for new, old in enumerate(red)}
        kept = [self.nodes[i] for i in red]
        for node in kept:
            node.next = {c: names[i] for c, i in node.next.items()}
        self.nodes = kept

    def length_rate(self, n: int) -> float:
        """Log share of the examples of n symbols, or, where examples have more than eight lengths, of an eighth more or less."""
        slack = n // 8 if len(self.lengths) > 8 else 0
        near = sum(c for k, c in self.lengths.items() if abs(k - n) <= slack)
        return math.log(near / self.total) if near else -math.inf

    def rate(self, s: str) -> float:
        """Log-likelihood of s for each symbol: of its symbols by the states, of its end by the length; minus infinity where a symbol or an end was never seen."""
        return next((r for n, r in self.rates(s) if n == len(s)), -math.inf) if s else -math.inf

    def rates(self, s: str) -> Iterator[tuple[int, float]]:
        """(n, rate(s[:n])) of every start of s that is accepted."""
        at, total = 0, 0.0
        for n, c in enumerate(s, 1):
            node = self.nodes[at]
            if c not in node.next:
                return
            total += math.log(node.took[c] / (node.seen - node.ends))
            at = node.next[c]
            if self.nodes[at].ends:
                yield n, (total + self.length_rate(n)) / (n + 1)
