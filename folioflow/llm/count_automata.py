"""Weighted acyclic automata over words: each accepted phrase has a count.

A state's arcs lie side by side, by label; an arc has the count of the phrase that ends with it (0 if none
does) and the state it leads to. Automata grow from sorted phrases, level by level: a phrase adds the
arcs that its forerunner does not have. From the last level up, states with the same arcs become one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable

import numpy as np

#: By length: one row of symbol numbers per phrase, and the counts.
Phrases = dict[int, tuple[np.ndarray, np.ndarray]]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(*values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of rows of whole numbers."""
    h = np.zeros(len(values[0]), np.uint64)
    for v in values:
        h = (h ^ v.astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(29)
    return h


def _small(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


class CountAutomaton:
    def __init__(self, symbols: list[bytes], first: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray):
        """``symbols`` are sorted words. State s has the arcs ``first[s]`` to ``first[s + 1]``; state 0 has none, the last is the root."""
        self.symbols, self.first, self.label, self.weight, self.target = symbols, first, label, weight, target

    @classmethod
    def build(cls, symbols: list[bytes], phrases: Phrases) -> CountAutomaton:
        """Equal phrases add up; phrases may come in any order."""
        base, levels = max(len(symbols), 1), []
        at = {k: np.zeros(len(ids), np.int64) for k, (ids, _) in phrases.items()}
        for depth in range(1, max(phrases, default=0) + 1):
            here = [k for k in sorted(phrases) if k >= depth]
            keys = np.concatenate([at[k] * base + phrases[k][0][:, depth - 1] for k in here])
            arcs, own = np.unique(keys, return_inverse=True)
            weight, start = np.zeros(len(arcs), np.int64), 0
            for k in here:
                at[k] = own[start : start + len(at[k])]
                start += len(at[k])
            if depth in phrases:
                np.add.at(weight, at[depth], phrases[depth][1])
            levels.append((arcs // base, arcs % base, weight))

        counts, parts = [np.zeros(1, np.int64)], []
        states, target_of = 1, np.zeros(len(levels[-1][0]) if levels else 0, np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            parent, label, weight = levels[depth]
            start = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])) if len(parent) else np.zeros(0, np.int64)
            kept, same = _distinct(start, np.diff(np.append(start, len(parent))), label, weight, target_of)
            above = np.zeros(len(levels[depth - 1][0]) if depth else 1, np.int64)
            above[parent[start]] = states + same
            width = np.diff(np.append(start, len(parent)))[kept]
            arcs = np.repeat(start[kept] - np.append(0, np.cumsum(width)[:-1]), width) + np.arange(width.sum())
            counts.append(width)
            parts.append((label[arcs], weight[arcs], target_of[arcs]))
            states += len(kept)
            target_of = above
        first = np.append(0, np.cumsum(np.concatenate(counts)))
        label, weight, target = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
        return cls(symbols, first, label, weight, target)

    def phrases(self) -> Phrases:
        """All phrases, sorted."""
        out: Phrases = {}
        state, path = np.array([len(self.first) - 2]), np.zeros((1, 0), np.int64)
        while len(state):
            width = self.first[state + 1] - self.first[state]
            arcs = np.repeat(self.first[state] - np.append(0, np.cumsum(width)[:-1]), width) + np.arange(width.sum())
            path = np.hstack([np.repeat(path, width, axis=0), self.label[arcs][:, None]])
            ends = self.weight[arcs] > 0
            if ends.any():
                out[path.shape[1]] = path[ends], self.weight[arcs][ends]
            on = self.target[arcs] > 0
            state, path = self.target[arcs][on], path[on]
        return out

    def compose(self, parts: list[list[bytes]]) -> np.ndarray:
        """The count of each part, 0 if it is not accepted: all parts walk the arcs together."""
        number = {w: i for i, w in enumerate(self.symbols)}
        base = max(len(self.symbols), 1)
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        arcs = np.append(owner * base + self.label, np.iinfo(np.int64).max)
        out = np.zeros(len(parts), np.int64)
        going, state = np.arange(len(parts)), np.full(len(parts), len(self.first) - 2)
        for depth in range(max(map(len, parts), default=0)):
            label = np.array([number.get(parts[i][depth], -1) if depth < len(parts[i]) else -1 for i in going], np.int64)
            wanted = state * base + label
            arc = np.searchsorted(arcs, wanted)
            hit = (label >= 0) & (arcs[arc] == wanted)
            going, arc = going[hit], arc[hit]
            last = np.array([len(parts[i]) == depth + 1 for i in going], bool)
            out[going[last]] = self.weight[arc[last]]
            going, state = going[~last], self.target[arc[~last]]
        return out

    def to_bytes(self) -> bytes:
        arrays = [_small(a) for a in (np.diff(self.first), self.label, self.weight, self.target)]
        return pickle.dumps((b" ".join(self.symbols), *arrays), protocol=5)

    @classmethod
    def from_bytes(cls, data: bytes) -> CountAutomaton:
        words, counts, *arrays = pickle.loads(data)
        first = np.append(0, np.cumsum(counts.astype(np.int64)))
        return cls(words.split(b" ") if words else [], first, *(a.astype(np.int64) for a in arrays))


def _distinct(start: np.ndarray, width: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which states stand for all with the same arcs, and for every state the place of its stand-in among them."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marks = mixed(np.add.reduceat(mixed(label, weight, target), start), width)
    _, stand, own = np.unique(marks, return_index=True, return_inverse=True)
    # Equal hashes are compared arc by arc.
    twin = stand[own]
    differs = width != width[twin]
    arc = np.arange(len(label)) - np.repeat(start, width)
    other = np.repeat(start[twin], width) + np.minimum(arc, np.repeat(width[twin], width) - 1)
    unlike = (label != label[other]) | (weight != weight[other]) | (target != target[other])
    differs |= np.add.reduceat(unlike, start) > 0
    alone = np.flatnonzero(differs)
    own[alone] = len(stand) + np.arange(len(alone))
    return np.append(stand, alone), own


def union(automata: Iterable[CountAutomaton]) -> CountAutomaton:
    """One automaton with the counts of all, summed."""
    automata = list(automata)
    symbols = sorted(set().union(*(a.symbols for a in automata)))
    number = {w: i for i, w in enumerate(symbols)}
    held: dict[int, list] = {}
    for a in automata:
        place = np.array([number[w] for w in a.symbols], np.int64)
        for k, (ids, weights) in a.phrases().items():
            held.setdefault(k, []).append((place[ids], weights))
    return CountAutomaton.build(symbols, {k: (np.concatenate([i for i, _ in v]), np.concatenate([w for _, w in v])) for k, v in held.items()})
