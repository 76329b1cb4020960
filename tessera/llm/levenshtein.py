"""A lexicon's trie intersected with Levenshtein automata, as one table that walks whole columns of words at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Code points beyond are never part of a word.
_PLANE = 1 << 16
_WORD = np.zeros(_PLANE, dtype=bool)
_WORD[[i for i in range(_PLANE) if chr(i).isalnum() or chr(i) in "@$"]] = True


@dataclass(frozen=True)
class Term:
    """`stem` terms match all words that begin with them; `edits` is how many changed characters are allowed."""

    text: str
    weight: float
    stem: bool = False
    edits: int = 0


class Trie:
    def __init__(self, terms: Sequence[Term]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.budget = [0]
        for t, term in enumerate(terms):
            node = 0
            self.budget[0] = max(self.budget[0], term.edits)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.budget.append(0)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], term.edits)
            self.ends[node].append(t)


class Automaton:
    """States are sets of (trie node, edits so far); state 0 is dead, state 1 the start.

    `term` and `distance` tell what a word that ends in a state matches: the fewest edits, then the longest term."""

    def __init__(self, terms: Sequence[Term]):
        self.terms = list(terms)
        trie = Trie(self.terms)
        alphabet = sorted({c for x in self.terms for c in x.text})
        self.classes = np.zeros(_PLANE, dtype=np.uint8 if len(alphabet) < 255 else np.uint16)
        for i, c in enumerate(alphabet):
            self.classes[ord(c)] = i + 1
        start = self._closed(trie, {0: 0}, {})
        known, states, table = {(): 0, start: 1}, [(), start], []
        for at in states:  # grows while states are found
            row = [self._id(self._step(trie, at, c), known, states) for c in ("", *alphabet)] if at else [0] * (len(alphabet) + 1)
            table.append(row)
        self.table = np.array(table, dtype=np.int32)
        best = [self._best(trie, s) for s in states]
        self.term = np.array([t for t, _ in best], dtype=np.int32)
        self.distance = np.array([e for _, e in best], dtype=np.int32)

    @staticmethod
    def _id(state: tuple, known: dict, states: list) -> int:
        if state not in known:
            known[state] = len(states)
            states.append(state)
        return known[state]

    def _closed(self, trie: Trie, nodes: dict[int, int], hits: dict[int, int]) -> tuple:
        """With the nodes that skipping characters of terms reaches, and the stems that are complete."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            if nodes.get(node) != e:
                continue
            for child in trie.children[node].values():
                if e + 1 <= trie.budget[child] and e + 1 < nodes.get(child, 99):
                    nodes[child] = e + 1
                    todo.append((child, e + 1))
        for node, e in nodes.items():
            for t in trie.ends[node]:
                if self.terms[t].stem and e <= self.terms[t].edits:
                    hits[t] = min(e, hits.get(t, 99))
        return tuple(sorted((n, e) for n, e in nodes.items() if e <= trie.budget[n])) + tuple(sorted((-t - 1, e) for t, e in hits.items()))

    def _step(self, trie: Trie, state: tuple, c: str) -> tuple:
        nodes: dict[int, int] = {}
        hits: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if e <= trie.budget[node] and e < nodes.get(node, 99):
                nodes[node] = e

        for node, e in state:
            if node < 0:
                hits[-node - 1] = e
                continue
            reach(node, e + 1)
            for own, child in trie.children[node].items():
                reach(child, e if own == c else e + 1)
        return self._closed(trie, nodes, hits)

    def _best(self, trie: Trie, state: tuple) -> tuple[int, int]:
        found = [(e, -len(self.terms[-n - 1].text), -n - 1) for n, e in state if n < 0]
        found += [(e, -len(self.terms[t].text), t) for n, e in state if n >= 0 for t in trie.ends[n] if e <= self.terms[t].edits]
        if not found:
            return -1, 0
        e, _, t = min(found)
        return t, e

    def walk(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the words points[start:end]: the places of those that match, their terms and distances."""
        state = np.ones(len(starts), dtype=np.int32)
        active = np.flatnonzero(ends > starts)
        at = 0
        while len(active):
            state[active] = self.table[state[active], self.classes[points[starts[active] + at]]]
            at += 1
            active = active[(state[active] != 0) & (starts[active] + at < ends[active])]
        hits = np.flatnonzero(self.term[state] >= 0)
        return hits, self.term[state[hits]], self.distance[state[hits]]


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased texts end to end as numbers below 2**16 (0 for those beyond), and where each begins; the last is the end."""
    lowered = [(x or "").lower() for x in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.append(0, np.cumsum([len(x) for x in lowered])).astype(np.int64)
    return np.where(points < _PLANE, points, 0), bounds


def word_bounds(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words (runs of letters, digits, @ and $) begin and end, and the first word of each text, with the count last."""
    word = _WORD[points]
    before, after = np.ones(len(points), dtype=bool), np.ones(len(points), dtype=bool)
    before[1:], after[:-1] = ~word[:-1], ~word[1:]
    full = bounds[1:] > bounds[:-1]
    before[bounds[:-1][full]] = True
    after[bounds[1:][full] - 1] = True
    starts, ends = np.flatnonzero(before & word), np.flatnonzero(after & word) + 1
    return starts, ends, np.searchsorted(starts, bounds)
