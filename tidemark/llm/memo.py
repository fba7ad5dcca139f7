"""Texts cut where tokenizers cut them anyway, and a bounded memory of what such chunks became."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

#: Characters of Unicode's White_Space property.
_SPACE = "\t-\r \x85\xa0  -     　"
_OTHER = "\t\x0b-\r\x85\xa0  -     　"  # without space and line feed
#: White space and what follows it, up to a space or line feed that comes straight after another character.
CHUNKS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+(?:[{_OTHER}][{_SPACE}]*[^{_SPACE}]*)*|[{_SPACE}]+")


class Ragged:
    """Rows of integers one after another."""

    def __init__(self):
        self.flat, self.starts, self.sizes, self.used, self.rows = np.zeros(1024, np.int32), np.zeros(1024, np.int64), np.zeros(1024, np.int64), 0, 0

    def add(self, sizes: np.ndarray, values: np.ndarray) -> None:
        while self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(sizes) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        at = slice(self.rows, self.rows + len(sizes))
        self.sizes[at] = sizes
        self.starts[at] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + len(values)] = values
        self.used, self.rows = self.used + len(values), self.rows + len(sizes)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        many = self.sizes[rows]
        ends = np.cumsum(many)
        n = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[rows] - (ends - many), many) + np.arange(n)], many


class Memo(dict):
    """Numbers items as they are met; ``compute`` turns new ones into ``columns`` of ragged integers, as (sizes, values) pairs.

    Holds at most about ``most`` items: beyond that it starts anew between
    calls of ``numbers``, so numbers hold until the next call only.
    """

    def __init__(self, compute: Callable[[list], list[tuple[np.ndarray, np.ndarray]]], columns: int, most: int, cleared: Callable[[], None] = lambda: None):
        super().__init__()
        self.compute, self.columns, self.most, self.cleared = compute, columns, most, cleared
        self.new: list = []
        self.held = [Ragged() for _ in range(columns)]

    def __missing__(self, item) -> int:
        number = self[item] = len(self)
        self.new.append(item)
        return number

    def numbers(self, items: list) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
            self.held = [Ragged() for _ in range(self.columns)]
            self.cleared()
        found = np.fromiter(map(self.__getitem__, items), np.int64, len(items))
        if self.new:
            for column, (sizes, values) in zip(self.held, self.compute(self.new)):
                column.add(sizes, values)
            self.new = []
        return found

    def take(self, column: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the numbered items one after another, and how many each has."""
        return self.held[column].take(numbers)
