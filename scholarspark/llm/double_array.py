"""A double-array trie over word codes, walked from many text positions at once."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A word code is two digits, so a node has at most this many children.
DIGIT = 1024
FREE = -1


class DoubleArray:
    """States are slots: the child of state s by digit d is ``base[s] + d`` if ``check`` there is s. States 1..words are
    the single words, children of the root 0 by their code; longer phrases go two digits a word.

    Sets of children are placed at random bases, larger sets first, into an array about half full; a set that finds no
    place goes to the end. The seed is fixed, so the same phrases give the same states.
    """

    def __init__(self, words: int):
        if words >= DIGIT * DIGIT:
            raise ValueError(f"at most {DIGIT * DIGIT - 1} words")
        self.words = words
        self.check = np.zeros(words + 1, np.int32)                # the root's own slot is never a child
        self.base = np.zeros(words + 1, np.int32)
        self.rng = np.random.default_rng(11)

    def _grow(self, n: int) -> None:
        """Make room for n more children."""
        self.check = np.append(self.check, np.full(n, FREE, np.int32))
        self.base = np.append(self.base, np.zeros(n, np.int32))

    def _place(self, parents: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """Slots of the children (parents ascending, none of which has children yet)."""
        self._grow(2 * len(parents) + DIGIT)
        starts = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        sizes = np.diff(np.append(starts, len(parents)))
        for g in np.argsort(-sizes, kind="stable"):
            if sizes[g] < 4:
                break
            own = digits[starts[g]:starts[g] + sizes[g]]
            tries = self.rng.integers(self.words + 1, len(self.check) - DIGIT, 256)
            good = np.flatnonzero((self.check[tries[:, None] + own] == FREE).all(axis=1))
            if len(good):
                at = int(tries[good[0]])
            else:
                at = len(self.check)
                self._grow(DIGIT)
            self.base[parents[starts[g]]] = at
            self.check[at + own] = parents[starts[g]]
        for size in (3, 2, 1):
            left = starts[sizes == size]
            while len(left):
                own = digits[left[:, None] + np.arange(size)]
                bases = self.rng.integers(self.words + 1, len(self.check) - DIGIT, len(left))
                slots = bases[:, None] + own
                free = (self.check[slots] == FREE).all(axis=1)
                claim = np.full(len(self.check), FREE, np.int32)   # two sets may want the same slot: the last one has it
                claim[slots[free]] = np.flatnonzero(free)[:, None]
                won = free & (claim[slots] == np.arange(len(left))[:, None]).all(axis=1)
                self.check[slots[won]] = parents[left[won]][:, None]
                self.base[parents[left[won]]] = bases[won]
                left = left[~won]
        return self.base[parents] + digits

    def add(self, heads: np.ndarray, lasts: np.ndarray) -> np.ndarray:
        """Add the phrases ``heads`` (states) followed by the words ``lasts`` (codes), distinct, all of one length; their states."""
        if not len(heads):
            return np.zeros(0, np.int32)
        order = np.lexsort((lasts, heads))
        h, c = heads[order].astype(np.int64), lasts[order].astype(np.int64)
        high = h * DIGIT + c // DIGIT
        new = np.append(True, high[1:] != high[:-1])
        between = self._place((high[new] // DIGIT).astype(np.int32), (high[new] % DIGIT).astype(np.int32))
        mids = between[np.cumsum(new) - 1]
        by_mid = np.argsort(mids, kind="stable")
        states = np.empty(len(h), np.int32)
        states[by_mid] = self._place(mids[by_mid], (c % DIGIT).astype(np.int32)[by_mid])
        out = np.empty(len(h), np.int32)
        out[order] = states
        return out

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states after one more word each; 0 where there is none (or where state or code is not positive)."""
        out = np.zeros(len(states), np.int32)
        some = np.flatnonzero((states > 0) & (codes > 0))
        s, c = states[some], codes[some]
        for digit in (c // DIGIT, c % DIGIT):
            at = self.base[s] + digit
            at[at >= len(self.check)] = 0
            s = np.where((s > 0) & (at > 0) & (self.check[at] == s), at, 0)
        out[some] = s
        return out
