"""What a worker remembers of stretches of text that come again: a number for each, and values by number."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain

import numpy as np

#: Numbers given out, and bytes of the stretches that have one, after which a worker starts afresh.
REMEMBERED, REMEMBERED_BYTES = 2_000_000, 32 << 20


class Numbers(dict):
    """Numbers stretches as they first appear; a number is spent on every one that is looked up."""

    def __init__(self):
        super().__init__()
        self.spent = 0
        self.size = 0

    @property
    def full(self) -> bool:
        return self.spent > REMEMBERED or self.size > REMEMBERED_BYTES

    def of(self, stretches: list) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of different stretches, and whether each is new."""
        fresh = range(self.spent, self.spent + len(stretches))
        numbers = np.fromiter(map(self.setdefault, stretches, fresh), np.int64, len(stretches))
        new = numbers == np.arange(fresh.start, fresh.stop)
        self.spent += len(stretches)
        return numbers, new


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind=np.int64):
        self.values, self.n = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        need = self.n + len(more)
        if need > len(self.values):
            self.values = np.concatenate((self.values[: self.n], np.zeros(max(need, 2 * len(self.values)) - self.n, self.values.dtype)))
        self.values[self.n : need] = more
        self.n = need


class Lists:
    """A list of values for each number in turn, one after the other."""

    def __init__(self, kind=np.int64):
        self.flat, self.starts, self.sizes = Grown(kind), Grown(), Grown()

    def add(self, flat: np.ndarray, sizes: Iterable[int]) -> None:
        sizes = np.asarray(sizes, np.int64)
        self.starts.add(self.flat.n + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.flat.add(flat)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of all numbers in a row, and how many each has."""
        sizes = self.sizes.values[numbers]
        before = np.cumsum(sizes) - sizes
        places = np.arange(int(sizes.sum())) + np.repeat(self.starts.values[numbers] - before, sizes)
        return self.flat.values[places], sizes


def sums_at(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` of the stretches that end at ``ends``."""
    return np.diff(np.concatenate(([0], np.cumsum(values)))[ends], prepend=0)


def flattened(lists: list, kind=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists in a row, and how many each has."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), kind, int(sizes.sum())), sizes


def dealt_back(mine: np.ndarray, these: tuple[np.ndarray, np.ndarray], others: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values in a row and their numbers, where ``mine`` tells which lists are those of the first pair."""
    sizes = np.zeros(len(mine), np.int64)
    sizes[mine], sizes[~mine] = these[1], others[1]
    flat, first = np.zeros(int(sizes.sum()), these[0].dtype), np.repeat(mine, sizes)
    flat[first], flat[~first] = these[0], others[0]
    return flat, sizes
