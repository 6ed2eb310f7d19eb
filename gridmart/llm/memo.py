"""A bounded memory of what was made for a key, for whole arrays of keys, that outlives a task in a reused worker."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np


class RaggedMemo:
    """For each 64-bit key some byte strings, one per field, kept in flat arrays.

    ``make`` takes the places of new keys in the asked ones and returns, per field, a list of byte strings. At most about
    ``limit`` keys stay; then all are forgotten and made again when they are asked for, so results do not depend on it.
    Two texts of one hash would be taken for one: among the million keys of a slice the odds are 1 in 10^7.
    """

    def __init__(self, fields: int, limit: int):
        self.fields, self.limit = fields, limit
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.rows = np.zeros(0, np.int64)
        self.flat = [np.zeros(1 << 16, np.uint8) for _ in range(self.fields)]
        self.ends = [np.zeros(1, np.int64) for _ in range(self.fields)]  # row i lies between ends i and i + 1

    def of(self, keys: np.ndarray, make: Callable[[np.ndarray], Sequence[list[bytes]]]) -> np.ndarray:
        """The rows of distinct, ascending ``keys``."""
        place = np.searchsorted(self.keys, keys)
        inside = place < len(self.keys)
        known = np.zeros(len(keys), bool)
        known[inside] = self.keys[place[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new) and len(self.keys) + len(new) > self.limit and len(self.keys):
            self._forget()
            return self.of(keys, make)
        rows = np.empty(len(keys), np.int64)
        rows[known] = self.rows[place[known]]
        if len(new):
            first = len(self.keys)
            for field, values in enumerate(make(new)):
                self._append(field, values)
            rows[new] = first + np.arange(len(new))
            self.keys = np.insert(self.keys, place[new], keys[new])
            self.rows = np.insert(self.rows, place[new], rows[new])
        return rows

    def _append(self, field: int, values: list[bytes]) -> None:
        ends = self.ends[field]
        more = ends[-1] + np.cumsum([len(x) for x in values])
        if more[-1] > len(self.flat[field]):
            grown = np.zeros(max(int(more[-1]), 2 * len(self.flat[field])), np.uint8)
            grown[: ends[-1]] = self.flat[field][: ends[-1]]
            self.flat[field] = grown
        self.flat[field][ends[-1] : more[-1]] = np.frombuffer(b"".join(values), np.uint8)
        self.ends[field] = np.concatenate((ends, more))

    def joined(self, field: int, rows: np.ndarray, item: type = np.uint8) -> tuple[np.ndarray, np.ndarray]:
        """The values of ``rows`` one after the other, as items of a type, and where each ends."""
        width = np.dtype(item).itemsize
        begin = self.ends[field][rows] // width
        ends = np.cumsum(self.ends[field][rows + 1] // width - begin)
        lengths = np.diff(ends, prepend=0)
        flat = self.flat[field][: len(self.flat[field]) // width * width].view(item)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(flat)) < 2**31 else np.int64
        at = np.repeat((begin - ends + lengths).astype(kind), lengths)
        at += np.arange(total, dtype=kind)
        return flat[at], ends
