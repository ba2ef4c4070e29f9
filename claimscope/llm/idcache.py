"""Ids of distinct strings, made once a worker: Arrow strings and one array of ids, no object per string or id."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Strings of a generation.
REMEMBER = 400_000

#: Strings (large binary) to the number of ids of each, and all ids one after the other.
Maker = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


class _Known:
    """Strings and their ids, in the order learned."""

    def __init__(self) -> None:
        self.strings = pa.array([], pa.large_binary())
        self.ends = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def add(self, strings: pa.Array, count: np.ndarray, ids: np.ndarray) -> None:
        if len(strings):  # concatenated into memory of its own: the strings share a batch's text
            self.strings = pa.concat_arrays([self.strings, strings])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(count)])
            self.ids = np.concatenate([self.ids, ids])


class IdCache:
    """Remembers the strings of two generations of ``REMEMBER`` strings."""

    def __init__(self, make: Maker):
        self.make = make
        self.now, self.before = _Known(), _Known()

    def lookup(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place and number of every distinct string's ids in an array of ids."""
        where = pc.index_in(strings, value_set=self.now.strings)
        missing = where.is_null()
        if pc.any(missing).as_py():
            new = strings.filter(missing)
            if len(self.before.strings):
                old = pc.index_in(new, value_set=self.before.strings)
                there = old.is_valid()
                place = np.asarray(old.filter(there), dtype=np.int64)
                begin, end = self.before.ends[place], self.before.ends[place + 1]
                self.now.add(new.filter(there), end - begin, runs(self.before.ids, begin, end))
                new = new.filter(old.is_null())
            if len(new):
                self.now.add(new, *self.make(new))
            where = pc.index_in(strings, value_set=self.now.strings)
        place = np.asarray(where, dtype=np.int64)
        known = self.now
        if len(known.strings) > REMEMBER:
            self.before, self.now = known, _Known()
        return known.ends[place], known.ends[place + 1] - known.ends[place], known.ids


class Made:
    """Collects ids of strings made out of order."""

    def __init__(self, n: int):
        self.count = np.zeros(n, np.int64)
        self.ids: list[np.ndarray] = [np.zeros(0, np.uint32)]
        self.places: list[np.ndarray] = [np.zeros(0, np.int64)]

    def put(self, places: np.ndarray, count: np.ndarray | list[int], ids: np.ndarray) -> None:
        self.count[places] = count
        self.ids.append(ids)
        self.places.append(places)

    def put_each(self, places: np.ndarray, each: list[list[int]]) -> None:
        self.put(places, [len(x) for x in each], np.array([i for x in each for i in x], np.uint32))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        places = np.concatenate(self.places)
        begin = np.zeros(len(self.count), np.int64)
        begin[places] = np.cumsum(self.count[places]) - self.count[places]
        return self.count, runs(np.concatenate(self.ids), begin, begin + self.count)


def runs(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The runs ``values[begin:end]`` one after the other."""
    n = end - begin
    if not len(n):
        return values[:0]
    total = np.cumsum(n)
    return values[np.arange(int(total[-1])) - np.repeat(total - n, n) + np.repeat(begin, n)]
