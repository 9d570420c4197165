"""A trie over whole numbers as two arrays, walked by many positions at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from wakeline.llm.text import pack, unpack

_WINDOW = 4096


class DoubleArray:
    """Children of a state by a symbol stand at ``base[state] + symbol`` if ``check`` there names the state.

    ``accept`` is the number of the sequence that ends in a state, or -1. Symbols are named by ``keys``, ascending.
    A sequence's first symbol is its state, where ``check`` is -1.
    """

    def __init__(self, keys: np.ndarray, base: np.ndarray, check: np.ndarray, accept: np.ndarray) -> None:
        self.keys, self.base, self.check, self.accept = keys, base, check, accept

    @classmethod
    def build(cls, sequences: np.ndarray, lengths: np.ndarray) -> DoubleArray:
        """Of the rows of ``sequences`` up to their lengths; a row's place is its number, and no two rows are equal."""
        inside = np.arange(sequences.shape[1]) < lengths[:, None]
        keys = np.unique(sequences[inside])
        symbols = np.where(inside, np.searchsorted(keys, np.where(inside, sequences, keys[:1])), 0) if len(keys) else sequences
        # nodes level by level, named by parent and symbol; node 0 is the root
        node = np.zeros(len(sequences), np.int64)
        parents, names, ends = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], np.full(1, -1)
        for level in range(sequences.shape[1]):
            rows = np.flatnonzero(lengths > level)
            if not len(rows):
                break
            fresh, which = np.unique(node[rows] * len(keys) + symbols[rows, level], return_inverse=True)
            parents.append(fresh // len(keys))
            names.append(fresh % len(keys))
            node[rows] = len(ends) + which
            ends = np.concatenate((ends, np.full(len(fresh), -1)))
        ends[node[lengths > 0]] = np.flatnonzero(lengths > 0)
        parent, name = np.concatenate(parents), np.concatenate(names)
        spot, offset = cls._placed(parent[1:], name[1:], len(keys), len(ends))
        size = int(spot.max(initial=0)) + 1
        base, check, accept = np.zeros(size, np.int64), np.full(size, -2, np.int64), np.full(size, -1, np.int64)
        base[spot[1:]] = offset[1:]
        accept[spot[1:]] = ends[1:]
        check[spot[1:]] = np.where(parent[1:] > 0, spot[parent[1:]], -1)
        return cls(keys, base, check, accept)

    @staticmethod
    def _placed(parent: np.ndarray, name: np.ndarray, symbols: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """The spot of each node and the base of its children: nodes with many children first, each where all fit."""
        order = np.lexsort((name, parent))
        owners, first, count = np.unique(parent[order], return_index=True, return_counts=True)
        used = np.zeros(max(1, 2 * (symbols + nodes)) + _WINDOW, bool)
        spot, offset = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        start = 0
        several = np.flatnonzero((count > 1) | (owners == 0))
        for k in several[np.lexsort((-count[several], owners[several] > 0))].tolist():
            children = order[first[k] : first[k] + count[k]]
            steps = name[children] - name[children[0]]
            at = 0 if owners[k] == 0 else start
            while owners[k] > 0:
                if at + _WINDOW + symbols >= len(used):
                    used = np.concatenate((used, np.zeros(len(used), bool)))
                free = at + np.flatnonzero(~used[at : at + _WINDOW])
                fits = free[~used[free[:, None] + steps].any(axis=1)]
                if len(fits):
                    at = int(fits[0])
                    break
                at += _WINDOW
            base = at - int(name[children[0]]) if owners[k] else 0
            offset[owners[k]] = base
            spot[children + 1] = base + name[children]
            used[base + name[children]] = True
            while used[start]:
                start += int(np.argmin(used[start : start + _WINDOW])) or _WINDOW
        # an only child fits anywhere
        alone = np.flatnonzero((count == 1) & (owners > 0))
        free = np.flatnonzero(~used)
        free = np.concatenate((free, np.arange(len(used), len(used) + max(0, len(alone) - len(free)))))[: len(alone)]
        children = order[first[alone]]
        spot[children + 1] = free
        offset[owners[alone]] = free - name[children]
        return spot, offset

    def symbols(self, keys: np.ndarray) -> np.ndarray:
        """The symbol of each key, -1 for one that no sequence has."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def walk(self, symbols: np.ndarray, group: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Level by level the places still alive and their states; a path stays within its ``group``."""
        at = np.flatnonzero(symbols >= 0)
        at = at[symbols[at] < len(self.check)]
        at = at[self.check[symbols[at]] == -1]
        state = symbols[at]
        for level in range(1, depth + 1):
            yield at, state
            on = at + level < len(symbols)
            at, state = at[on], state[on]
            on = (group[at + level] == group[at]) & (symbols[at + level] >= 0)
            at, state = at[on], state[on]
            to = self.base[state] + symbols[at + level]
            on = (to >= 0) & (to < len(self.check))
            at, state, to = at[on], state[on], to[on]
            on = self.check[to] == state
            at, state = at[on], to[on]

    def counts(self, symbols: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
        """How often each sequence occurs."""
        total = np.zeros(int(self.accept.max(initial=-1)) + 1, np.int64)
        for _, state in self.walk(symbols, group, depth):
            ended = self.accept[state]
            total += np.bincount(ended[ended >= 0], minlength=len(total))
        return total

    def to_bytes(self) -> bytes:
        return pack(self.keys, self.base, self.check, self.accept)

    @classmethod
    def from_bytes(cls, blob: bytes) -> DoubleArray:
        return cls(*unpack(blob))
