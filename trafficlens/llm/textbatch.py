"""Numpy views of Arrow text batches, shared by the operators that look at words.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. Words have
64-bit hashes of two kinds (``span_hashes``) and exact ids (``exact_ids``). Work goes in blocks of documents of bounded size, so
memory follows the block (or one very long document), never the partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_HASH_PARTS = 1 << 17

_WS = np.zeros(256, dtype=bool)
_WS[[32, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x452821E638D01377))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_string() if not pa.types.is_binary(column.type) else pa.large_binary())
    _, off, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES, rows: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Runs of documents [a, b) of at most ``limit`` bytes (or one document) and
    at most ``rows`` documents."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, n, a + rows)
        yield a, b
        a = b


_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def _eights(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The up to eight bytes from each position as one number."""
    near = at < len(data) - 7
    out = np.zeros(len(at), dtype=np.uint64)
    if near.any():
        windows = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (data.strides[0], data.strides[0]))
        out[near] = np.ascontiguousarray(windows[at[near]]).view("<u8").ravel()
    for i in np.flatnonzero(~near):
        out[i] = int.from_bytes(data[at[i]:at[i] + 8].tobytes(), "little")
    return out & _KEEP[np.minimum(size, 8)]


def _parts(start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(span, place, position, bytes) of the eight-byte parts of all spans, some at a time."""
    ends = np.cumsum(np.maximum((end - start + 7) >> 3, 1))
    total = int(ends[-1]) if len(ends) else 0
    for a in range(0, total, _HASH_PARTS):
        part = np.arange(a, min(a + _HASH_PARTS, total))
        span = np.searchsorted(ends, part, "right")
        place = part - np.where(span > 0, ends[span - 1], 0)
        at = start[span] + 8 * place
        yield span, place, at, end[span] - at


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seeds: int = 1) -> np.ndarray:
    """(seeds, spans): independent 64-bit hashes of each span of bytes. Every eight
    bytes are mixed with their place before they are added up, so the sum is no
    polynomial of the bytes and has none of its known collisions."""
    out = np.zeros((seeds, len(start)), dtype=np.uint64)
    for span, place, at, size in _parts(start, end):
        eight = _eights(data, at, size)
        where = (place.astype(np.uint64) + np.uint64(1)) * _STEP
        first = np.flatnonzero(np.concatenate([[True], span[1:] != span[:-1]]))
        for k in range(seeds):
            out[k, span[first]] += np.add.reduceat(mix(mix(eight + _SEEDS[k]) ^ where), first)
    size = (end - start).astype(np.uint64)
    return np.stack([mix(out[k] ^ mix(size + _SEEDS[k])) for k in range(seeds)])


def exact_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each span, the same for two spans if and only if their bytes are
    equal: spans of one hash are compared with the first of them."""
    _, first, same = np.unique(span_hashes(data, start, end)[0], return_index=True, return_inverse=True)
    model = first[same]
    equal = end - start == end[model] - start[model]
    for span, place, at, size in _parts(start, end):
        check = np.flatnonzero(equal[span])
        there = start[model[span[check]]] + 8 * place[check]
        differs = _eights(data, at[check], size[check]) != _eights(data, there, size[check])
        equal[span[check[differs]]] = False
    if not equal.all():
        names: dict[bytes, int] = {}
        for i in np.flatnonzero(~equal).tolist():
            same[i] = len(first) + names.setdefault(data[start[i]:end[i]].tobytes(), len(names))
    return same


class Words:
    """Word spans of a block of documents: ``start``, ``end`` (byte offsets),
    ``first`` (word index of each document, one more at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        word = ~_WS[data]
        before = np.empty_like(word)
        before[1:], before[:1] = word[:-1], False
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        before[inner] = False
        after = np.empty_like(word)
        after[:-1], after[-1:] = word[1:], False
        after[inner - 1] = False
        self.in_word = word
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1, dtype=np.int32), self.counts)

    def hashes(self, seeds: int = 1) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end, seeds)

    def ids(self) -> np.ndarray:
        return exact_ids(self.data, self.start, self.end)

    def count_in_documents(self, mask: np.ndarray) -> np.ndarray:
        """Number of bytes of each document for which ``mask`` holds."""
        n = len(self.offsets) - 1
        if not len(mask):
            return np.zeros(n, np.int64)
        sums = np.add.reduceat(mask, np.minimum(self.offsets[:-1], len(mask) - 1), dtype=np.int64)
        sums[np.diff(self.offsets) == 0] = 0
        return sums

    def word_chars(self) -> np.ndarray:
        return self.count_in_documents(self.in_word & ((self.data & 0xC0) != 0x80))

    def symbols(self) -> np.ndarray:
        return self.count_in_documents(_SYMBOL[self.data])


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first) of the word shingles of each document of a block: windows of
    ``size`` words; a document of fewer words has one shingle, of all of them;
    one without words has none. ``first`` delimits the documents."""
    h = words.hashes()[0]
    n = words.counts
    out_n = np.where(n == 0, 0, np.maximum(1, n - size + 1))
    first = np.concatenate([[0], np.cumsum(out_n)])
    doc = np.repeat(np.arange(len(n)), out_n)
    at = words.first[:-1][doc] + (np.arange(first[-1]) - first[:-1][doc])
    end = words.first[1:][doc]
    acc = np.zeros(len(at), dtype=np.uint64)
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    for j in range(size):
        here = at + j
        acc = (acc + np.where(here < end, padded[here], np.uint64(j + 1))) * np.uint64(0xD6E8FEB86659FD93)
        acc ^= acc >> np.uint64(32)
    return mix(acc), first
