"""Sorted strings in levels of growing size, each with the smallest document that holds it."""

from __future__ import annotations

import numpy as np


def fixed(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes (n, length) as strings of that length, which compare byte by byte."""
    rows = np.ascontiguousarray(rows, np.uint8)
    return rows.view(f"S{rows.shape[1]}").ravel()


def grouped(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the smallest document of each, and each row's place among them."""
    order = np.argsort(docs, kind="stable")
    order = order[np.argsort(keys[order], kind="stable")]
    ordered = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(first) - 1
    return ordered[first], docs[order][first], place


class Levels:
    """A logarithmic family of suffix arrays.

    What comes in is gathered to batches of ``batch`` strings and sorted. A batch is scanned against every level: strings that a level has only lower the
    document there, the others make a level of their own. While the last level is no smaller than half
    the one before, the two are merged, so there are logarithmically many and a string is moved
    logarithmically often. A string is in one level only.
    """

    def __init__(self, batch: int = 1 << 16) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.batch, self.waiting, self.held = batch, [], 0
        self.batches: list[tuple[np.ndarray, np.ndarray]] = []  # distinct strings, and which of them each one put was

    def put(self, keys: np.ndarray, docs: np.ndarray) -> None:
        """Strings in any order, repeats too."""
        self.waiting.append((keys, docs))
        self.held += len(keys)
        if self.held >= self.batch:
            self._empty()

    def _empty(self) -> None:
        if self.waiting:
            keys, docs = (np.concatenate(x) for x in zip(*self.waiting))
            distinct, lowest, place = grouped(keys, docs)
            self.add(distinct, lowest)
            self.batches.append((distinct, place))
        self.waiting, self.held = [], 0

    def add(self, keys: np.ndarray, docs: np.ndarray) -> None:
        """One batch: sorted, distinct strings."""
        for known, lowest in self.levels:
            at = np.searchsorted(known, keys)
            at[at == len(known)] = 0
            same = known[at] == keys
            lowest[at[same]] = np.minimum(lowest[at[same]], docs[same])
            keys, docs = keys[~same], docs[~same]
        if len(keys):
            self.levels.append((keys, docs.copy()))
        while len(self.levels) > 1 and 2 * len(self.levels[-1][0]) >= len(self.levels[-2][0]):
            self._merge()

    def _merge(self) -> None:
        (a, x), (b, y) = self.levels.pop(), self.levels.pop()
        keys, docs = np.concatenate([b, a]), np.concatenate([y, x])
        order = np.argsort(keys, kind="stable")
        self.levels.append((keys[order], docs[order]))

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """All strings and their smallest documents, once everything is in (one string at least)."""
        self._empty()
        while len(self.levels) > 1:
            self._merge()
        return self.levels[0]

    def places(self) -> np.ndarray:
        """Where each string put is among all of them, in the order of putting."""
        known = self.whole()[0]
        return np.concatenate([np.searchsorted(known, keys)[place] for keys, place in self.batches])

    def lowest(self) -> np.ndarray:
        """The smallest document of each string put, in the order of putting."""
        return self.whole()[1][self.places()]
