"""A bounded memory of short byte strings and what they encode to.

Keys are 64-bit hashes of the strings in an open-addressing numpy table, so a
block of text is looked up with a few array operations; a second, independent
hash of 64 bits must agree too. What the table lacks is
computed once per block; while there is room it is kept for later blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .textbatch import span_hashes

LONGEST = 64


class ChunkTable:
    """``compute(list of byte strings)`` gives a list of bytes (uint32 values)."""

    def __init__(self, compute: Callable[[list[bytes]], list[bytes]], entries: int = 600_000):
        self.compute, self.entries = compute, entries
        bits = (2 * entries - 1).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.zeros(1 << bits, dtype=np.uint64)
        self.value = np.zeros(1 << bits, dtype=np.int32)
        self.start, self.size = np.zeros(entries, np.int64), np.zeros(entries, np.int32)
        self.check = np.zeros(entries, np.uint64)
        self.flat, self.used, self.n = np.zeros(1 << 20, np.uint32), 0, 0

    def _find(self, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Entry of each pair of hashes, -1 if it has none."""
        out = np.full(len(h), -1, dtype=np.int32)
        slot = (h >> self.shift).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            k, entry = self.key[slot], self.value[slot]
            hit = (k == h) & (self.check[entry] == check)
            out[left[hit]] = entry[hit]
            go = ~hit & (k != 0)
            left, h, check, slot = left[go], h[go], check[go], (slot[go] + 1) & self.mask
        return out

    def _put(self, h: np.ndarray, entry: np.ndarray) -> None:
        slot = (h >> self.shift).astype(np.int64)
        while len(h):
            free = self.key[slot] == 0
            self.key[slot[free]], self.value[slot[free]] = h[free], entry[free]
            left = ~free | (self.value[slot] != entry)
            h, entry, slot = h[left], entry[left], (slot[left] + 1) & self.mask

    def _append(self, values: np.ndarray) -> None:
        if self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(values), len(self.flat) // 2), np.uint32)])
        self.flat[self.used:self.used + len(values)] = values
        self.used += len(values)

    def lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, size, values): the uint32 values of span i are
        ``values[first[i]:first[i] + size[i]]``."""
        h, check = span_hashes(data, start, end, 2)
        h = h | np.uint64(1)
        entry = self._find(h, check)
        first, size = self.start[entry], self.size[entry].astype(np.int64)
        values = self.flat
        lacking = np.flatnonzero(entry < 0)
        if len(lacking):
            order = np.lexsort((check[lacking], h[lacking]))
            keys, checks = h[lacking[order]], check[lacking[order]]
            new_key = np.concatenate([[True], (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])])
            which = np.empty(len(order), np.int64)
            which[order] = np.cumsum(new_key) - 1
            at, keys, checks = order[new_key], keys[new_key], checks[new_key]
            s, e = start[lacking[at]], end[lacking[at]]
            raw = data.tobytes()
            got = self.compute([raw[a:b] for a, b in zip(s.tolist(), e.tolist())])
            sizes = np.array([len(x) // 4 for x in got], dtype=np.int64)
            new = np.frombuffer(b"".join(got), "<u4")
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            keep = np.flatnonzero(e - s <= LONGEST)[:self.entries - self.n]
            if len(keep):
                entries = self.n + np.arange(len(keep))
                kept = np.concatenate([new[a:a + n] for a, n in zip(starts[keep].tolist(), sizes[keep].tolist())]) if len(keep) < len(keys) else new
                self.start[entries] = self.used + np.concatenate([[0], np.cumsum(sizes[keep])[:-1]])
                self.size[entries] = sizes[keep]
                self._append(kept)
                self.check[entries] = checks[keep]
                self._put(keys[keep], entries.astype(np.int32))
                self.n += len(keep)
            values = np.concatenate([self.flat[:self.used], new])
            first[lacking], size[lacking] = self.used + starts[which], sizes[which]
        return first, size, values

    def expand(self, first: np.ndarray, size: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The values of all spans, one after the other."""
        total = np.cumsum(size)
        if not len(total) or not total[-1]:
            return np.zeros(0, np.uint32)
        return values[np.repeat(first - (total - size), size) + np.arange(total[-1])]
