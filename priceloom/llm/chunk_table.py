"""Distinct-chunk tables: every distinct chunk of a text is encoded once per
worker, and the ids are joined back by position.

The tables live in the Python worker and hold a bounded number of chunks: a
full one keeps those met again, so neither its size nor a lost worker
matters."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

#: Most chunks a worker's table holds.
TABLE_CHUNKS = 400_000


class ChunkTable:
    """Ids of chunks, as one flat array with bounds.  ``encode`` gives those
    of some chunks, as a list each or as one array and each chunk's number."""

    def __init__(self, encode: Callable[[list], list | tuple], dtype=np.uint16, most: int = TABLE_CHUNKS):
        self._encode, self._dtype, self._most = encode, dtype, most
        self._index: dict = {}
        self._flat, self._used = np.zeros(1 << 16, self._dtype), 0
        self._start, self._len, self._uses = (np.zeros(1 << 14, np.int64) for _ in range(3))

    def _evict(self) -> None:
        """Chunks met again since the last time stay, if they are at most half
        of what the table holds; else the half of them met most often."""
        n = len(self._index)
        uses = self._uses[:n]
        keep = np.flatnonzero(uses > 1)
        if 2 * len(keep) > self._most:
            keep = np.sort(keep[np.argsort(-uses[keep], kind="stable")[:self._most // 2]])
        ids, lens = self.gather(keep)
        chunks = list(self._index)
        self._index = {chunks[k]: i for i, k in enumerate(keep.tolist())}
        self._uses[:len(keep)] = 1
        self._used = 0
        self._append(0, ids, lens)

    def _room(self, name: str, need: int) -> None:
        a = getattr(self, name)
        if need > len(a):
            setattr(self, name, np.concatenate([a, np.zeros(max(need, 2 * len(a)) - len(a), a.dtype)]))

    def _append(self, first: int, ids: np.ndarray, lens: np.ndarray) -> None:
        rows, total = first + len(lens), self._used + len(ids)
        for name, need in (("_flat", total), ("_start", rows), ("_len", rows), ("_uses", rows)):
            self._room(name, need)
        self._flat[self._used:total] = ids
        self._len[first:rows] = lens
        self._start[first:rows] = self._used + np.cumsum(lens) - lens
        self._used = total

    def rows(self, chunks: list) -> np.ndarray:
        """Each distinct chunk's row; chunks not met before are encoded."""
        if len(self._index) > self._most:
            self._evict()
        at = np.fromiter(map(self._index.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = [chunks[i] for i in new.tolist()]
            ids = self._encode(fresh)
            if isinstance(ids, list):
                lens = np.fromiter(map(len, ids), np.int64, len(ids))
                ids = np.fromiter(chain.from_iterable(ids), self._dtype, int(lens.sum())), lens
            n0 = len(self._index)
            at[new] = np.arange(n0, n0 + len(new))
            self._index.update(zip(fresh, range(n0, n0 + len(new))))
            self._append(n0, *ids)
            self._uses[n0:n0 + len(new)] = 0
        self._uses[at] += 1
        return at

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the given rows in a line, and each row's number of ids."""
        lens = self._len[rows]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.repeat(self._start[rows] - (ends - lens), lens) + np.arange(total)], lens


def distinct(chunks: pa.Array) -> tuple[list, np.ndarray]:
    """The distinct values and each position's place among them."""
    d = chunks.dictionary_encode()
    return d.dictionary.to_numpy(zero_copy_only=False).tolist(), d.indices.to_numpy(zero_copy_only=False)


def text_sums(lens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bounds of each text's ids, from the ids per chunk and chunks per text."""
    return np.concatenate([[0], np.cumsum(lens)])[bounds]
