"""Byte-level BPE encoding and decoding with segment trees.

A pre-token of n bytes has a segment tree over its byte positions. Leaf i holds
``rank * n + i`` for the pair that starts at live position i (rank: of the
pair's merge), so each inner node holds its leftmost minimum pair rank and the
root names the next merge. A merge updates three leaves - the merged position,
its left neighbour and the absorbed position - and their paths to the root.
Trees of equal width are kept as rows of one numpy array and step together, so
a batch of pre-tokens costs a few array operations per merge step. A bounded
memory keeps the ids of pre-tokens seen.

Null text encodes as empty; invalid input can't occur (text is UTF-8). Repeated
rows, null ids and extra columns pass; an empty table gives an empty result."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import slices
from .chunktable import ChunkTable
from .slot import held
from .textbatch import _WS as _SPACE
from .textbatch import blocks, buffers

MEMORY_PIECES = 400_000
_NONE = np.int64(1) << 60
_ROWS = 1 << 21


class BytePairs:
    """The merges of a rank file (base64 token, rank) as arrays."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = dict(zip(self.ranks.values(), self.ranks.keys()))
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = rank
        self.pair = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.pair.tolist()], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank (= id) of the merge of each pair, ``_NONE`` where there is none."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (left >= 0) & (right >= 0), self.merged[at], _NONE)


def encode_rows(pairs: BytePairs, pieces: list[bytes], width: int) -> list[np.ndarray]:
    """Ids of pieces of at most ``width`` bytes (a power of two)."""
    m = len(pieces)
    length = np.array([len(p) for p in pieces], dtype=np.int64)
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(m, width)
    inside = np.arange(width) < length[:, None]
    ids = np.where(inside, pairs.byte[raw], -1)
    following = np.tile(np.arange(1, width + 1), (m, 1))  # next live position
    before = np.tile(np.arange(-1, width - 1), (m, 1))
    tree = np.full((m, 2 * width), _NONE, dtype=np.int64)
    if width > 1:
        rank = pairs.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(m, width - 1)
        tree[:, width:2 * width - 1] = np.where(rank < _NONE, rank * width + np.arange(width - 1), _NONE)
    k = width
    while k > 1:
        half = k // 2
        tree[:, half:k] = np.minimum(tree[:, k:2 * k:2], tree[:, k + 1:2 * k:2])
        k = half

    def put(rows, leaf, value):
        tree[rows, width + leaf] = value
        node = (width + leaf) >> 1
        for _ in range(width.bit_length() - 1):
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            node = node >> 1

    def pair_at(rows, leaf):
        """What leaf ``leaf`` must hold now."""
        other = following[rows, leaf]
        right = np.where(other < width, ids[rows, np.minimum(other, width - 1)], -1)
        rank = pairs.rank(ids[rows, leaf], right)
        return np.where(rank < _NONE, rank * width + leaf, _NONE)

    rows = np.flatnonzero(tree[:, 1] < _NONE)
    while len(rows):
        best = tree[rows, 1]
        at, token = best % width, best // width
        gone = following[rows, at]
        after = following[rows, gone]
        ids[rows, at] = token
        ids[rows, gone] = -1
        following[rows, at] = after
        inner = after < width
        before[rows[inner], after[inner]] = at[inner]
        put(rows, gone, _NONE)
        put(rows, at, pair_at(rows, at))
        left = before[rows, at]
        has = left >= 0
        put(rows[has], left[has], pair_at(rows[has], left[has]))
        rows = rows[tree[rows, 1] < _NONE]
    live = ids >= 0
    flat, n = ids[live].astype("<u4"), live.sum(1)
    return np.split(flat, np.cumsum(n)[:-1])


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where a chunk starts: each text's start, and ASCII white
    space right after anything else. No pre-token reaches over these, and a
    chunk's pre-tokens are those of the text. White space beyond ASCII isn't
    known here; right after what may be such a character there is no cut."""
    space = _SPACE[data]
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = space[1:] & ~space[:-1]
    high = np.flatnonzero(cut & (np.concatenate([[0], data[:-1]]) >= 0x80)) if len(data) else np.zeros(0, np.int64)
    odd = (data[np.maximum(high - 2, 0)] == 0xC2) | np.isin(data[np.maximum(high - 3, 0)], (0xE1, 0xE2, 0xE3))
    cut[high[odd]] = False
    inner = offsets[:-1]
    cut[inner[inner < len(data)]] = True
    return np.flatnonzero(cut)


class ByteCodec:
    """Encoder and decoder over a rank file and a pre-token pattern."""

    def __init__(self, path: str, pattern: str, memory: int = MEMORY_PIECES):
        import regex

        self.pairs, self.memory = BytePairs(path), memory
        self.find = regex.compile(pattern).findall
        self.piece: dict[str, bytes] = {}  # pre-token -> ids
        self.table = ChunkTable(self._compute)
        self.bytes = np.frombuffer(b"".join(self.pairs.tokens[i] for i in range(len(self.pairs.tokens))), np.uint8)
        self.length = np.array([len(self.pairs.tokens[i]) for i in range(len(self.pairs.tokens))], dtype=np.int64)
        self.at = np.cumsum(self.length) - self.length

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes | None] = []
        by_width: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            rank = self.pairs.ranks.get(p)
            out.append(None if rank is None else rank.to_bytes(4, "little"))
            if rank is None:
                by_width.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for width, at in by_width.items():
            step = max(1, _ROWS // width)
            for k in range(0, len(at), step):
                for i, ids in zip(at[k:k + step], encode_rows(self.pairs, [pieces[j] for j in at[k:k + step]], width)):
                    out[i] = ids.tobytes()
        return out

    def _compute(self, chunks: list[bytes]) -> list[bytes]:
        found = [self.find(c.decode()) for c in chunks]
        new = sorted(set().union(*found).difference(self.piece))
        ids = dict(zip(new, self._merge([p.encode() for p in new])))
        if len(self.piece) + len(ids) <= self.memory:
            self.piece.update(ids)
            get = self.piece.__getitem__
        else:
            get = lambda p: self.piece.get(p) or ids[p]
        return [b"".join(map(get, f)) for f in found]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): all ids of a block of UTF-8 texts, and each text's limits."""
        start = _cuts(data, offsets)
        first, size, values = self.table.lookup(data, start, np.append(start[1:], len(data)))
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.table.expand(first, size, values), ends[np.searchsorted(start, offsets)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that a run of ids stands for."""
        size = self.length[ids]
        total = np.cumsum(size)
        if not len(ids):
            return np.zeros(0, np.uint8)
        return self.bytes[np.repeat(self.at[ids] - (total - size), size) + np.arange(total[-1])]


def codec(path: str, pattern: str) -> ByteCodec:
    """The codec of these files, built once in each worker."""
    return held(("byte ids", path, pattern), lambda: ByteCodec(path, pattern))


def _blocks(c: ByteCodec, batches: Iterator[pa.RecordBatch]):
    """(doc_id column, ids, first) of blocks of rows (doc_id, text)."""
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for a, b in blocks(offsets):
            yield batch.column(0).slice(a, b - a), *c.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, ids, first in _blocks(codec(path, pattern), batches):
            rows = [ids[a:b].astype("<u4").tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(rows, pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, decoded (binary) of every row of ``encode_texts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in slices(batches, 1):
            out = [c.decode(np.frombuffer(x or b"", "<u4")).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, then decode the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        decimal = list(map(str, range(len(c.pairs.tokens))))
        for doc_id, ids, first in _blocks(c, batches):
            texts, size = c.decode(ids).tobytes(), np.concatenate([[0], np.cumsum(c.length[ids])])
            words = list(map(decimal.__getitem__, ids.tolist()))
            ids_hash, text_hash = [], []
            for a, b, x, y in zip(first[:-1].tolist(), first[1:].tolist(), size[first[:-1]].tolist(), size[first[1:]].tolist()):
                ids_hash.append(hashlib.sha256(" ".join(words[a:b]).encode()).hexdigest())
                text_hash.append(hashlib.sha256(texts[x:y]).hexdigest())
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(np.diff(first)), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
