"""A run-length index: the run-compressed Burrows-Wheeler transform of many short byte strings."""

from __future__ import annotations

import numpy as np

SYMBOL_BITS = 9
# Symbols that fit one sort key at first.
FIRST = 6


def _ranked(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of sort keys."""
    order = np.argsort(keys)
    sorted_keys = keys[order]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(np.concatenate(([0], sorted_keys[1:] != sorted_keys[:-1])))
    return ranks


class RunIndex:
    """Strings, each with an owner, asked in which strings `length` symbols from any place come again.

    Suffixes are sorted by doubling; the transform is kept as runs with the rank of each, so that
    one step to the left is a look-up of a run. Suffixes that begin with the same `length` symbols
    stand together: the smallest owner among them is sampled where they begin.
    """

    def __init__(self, strings: np.ndarray, lengths: np.ndarray, owners: np.ndarray, length: int):
        """`strings`: a row of bytes each, as long as `lengths` says; `owners` in any order."""
        self.length, self.lengths = length, lengths
        n, width = strings.shape
        inside = np.arange(width + 1) <= lengths[:, None]
        symbols = np.zeros((n, width + 1), np.int64)
        symbols[:, :width] = np.where(inside[:, 1:], strings.astype(np.int64) + 1, 0)
        # One text: every string and a sentinel, which is smaller than any byte.
        text, left = symbols[inside], (lengths[:, None] - np.arange(width + 1))[inside]
        owner = np.repeat(owners, lengths + 1)
        order, prefix = self._sort(text, left)
        self._compress(text, order)
        # Where suffixes with `length` symbols stop being alike, and the smallest owner of each such class.
        whole = (left >= length)[order]
        rows = np.flatnonzero(whole)
        starts = rows[np.concatenate(([True], prefix[order[rows[1:]]] != prefix[order[rows[:-1]]]))] if len(rows) else rows
        self.class_starts = starts
        owners_of = np.where(whole, owner[order], np.iinfo(np.uint64).max)
        self.class_owner = np.minimum.reduceat(owners_of, starts) if len(starts) else np.zeros(0, np.uint64)
        self.symbols = symbols

    def _sort(self, text: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of all suffixes, and a number that is equal where `length` symbols are."""
        n, size = len(text), self.length

        def ahead(values: np.ndarray, step: int) -> np.ndarray:
            """The value `step` symbols on, 0 beyond the string's end."""
            shifted = np.zeros(n, np.int64)
            shifted[: n - step] = values[step:]
            return np.where(left >= step, shifted, 0)

        key = np.zeros(n, np.int64)
        for i in range(FIRST):
            key = key << SYMBOL_BITS | ahead(text, i)
        span, ranks, prefix = FIRST, _ranked(key), None
        longest = int(left.max()) + 1
        while span < longest:
            if prefix is None and 2 * span >= size:
                prefix = ranks * (n + 1) + ahead(ranks + 1, size - span)
            ranks = _ranked(ranks * (n + 1) + ahead(ranks + 1, span))
            span *= 2
        # Suffixes that are alike to their ends go in the order of the strings.
        return np.argsort(ranks * n + np.arange(n)), ranks if prefix is None else prefix

    def _compress(self, text: np.ndarray, order: np.ndarray) -> None:
        last = text[order - 1]
        starts = np.flatnonzero(np.concatenate(([True], last[1:] != last[:-1])))
        heads, sizes = last[starts], np.diff(np.append(starts, len(last)))
        by_symbol = np.argsort(heads, kind="stable")
        # Where the suffixes that begin with a run's symbol and go on as its rows begin.
        target = np.empty(len(heads), np.int64)
        target[by_symbol] = np.cumsum(sizes[by_symbol]) - sizes[by_symbol]
        self.run_starts, self.run_targets = starts, target

    def _step_left(self, rows: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.run_starts, rows, "right") - 1
        return self.run_targets[run] + rows - self.run_starts[run]

    def smallest_owners(self) -> np.ndarray:
        """For each string and place from which `length` symbols follow, the smallest owner of them.

        All strings are streamed from their ends to their beginnings, side by side. Places with
        fewer symbols have the largest number.
        """
        n, width = self.symbols.shape
        found = np.full((n, width), np.iinfo(np.uint64).max, np.uint64)
        # Sentinels sort first, in the order of the strings.
        rows, place = np.arange(n), self.lengths.copy()
        going = np.arange(n)
        while len(going := going[place[going] > 0]):
            rows[going] = self._step_left(rows[going])
            place[going] -= 1
            full = going[place[going] + self.length <= self.lengths[going]]
            at = np.searchsorted(self.class_starts, rows[full], "right") - 1
            found[full, place[full]] = self.class_owner[at]
        return found
