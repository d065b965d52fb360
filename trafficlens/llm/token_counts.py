"""Exact token counts by the whole-token shortcut.

Offline, once on the driver: each vocabulary string is put through the
library's own merges, and those that come out as one token are proven whole.
In the tasks a text is cut into pre-tokens: a proven one counts directly, only
the rest is merged. A bounded memory keeps the counts of white-space chunks
seen. The proven set is at most the vocabulary, so it is broadcast whatever the
corpus.

Null text counts as empty (0 bytes, 0 tokens). Repeated rows, null ids and extra
columns pass; an empty table gives an empty result. A text of any length is
counted whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunktable import ChunkTable
from .textbatch import Words, blocks, buffers
from .slot import held
from .wordbpe import Pieces, library

LIMIT = 2048
BLOCK_BYTES = 4 << 20
_END = "</w>"


def prove_whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings (without the word-end mark) that the library's merges
    leave as exactly their own single token."""
    t = library(path)
    proven = set()
    for text, i in t.get_vocab(with_added_tokens=False).items():
        if text.endswith(_END) and len(text) > len(_END):
            pieces = t.model.tokenize(text[:-len(_END)])
            if len(pieces) == 1 and pieces[0].id == i:
                proven.add(text[:-len(_END)])
    return frozenset(proven)


class TokenCounter:
    """Token counts of blocks of texts; ``whole`` is the proven set."""

    def __init__(self, path: str, whole: frozenset[str]):
        model = library(path).model
        self.whole = whole
        self.pieces = Pieces(path, lambda p: len(model.tokenize(p)))
        self.table = ChunkTable(self._compute)

    def _count(self, piece: str) -> int:
        return 1 if piece in self.whole else self.pieces.of(piece)

    def _compute(self, chunks: list[bytes]) -> list[bytes]:
        out: list = []
        for raw in chunks:
            cut = self.pieces.cut(text := raw.decode())
            out.append(sum(map(self._count, cut)) if cut is not None else text)
        at = [i for i, x in enumerate(out) if isinstance(x, str)]
        for i, e in zip(at, self.pieces.t.encode_batch([out[i] for i in at], add_special_tokens=False) if at else []):
            out[i] = len(e.ids)
        return [n.to_bytes(4, "little") for n in out]

    def block(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        words = Words(data, offsets)
        first, _, values = self.table.lookup(data, words.start, words.end)
        total = np.concatenate([[0], np.cumsum(values[first], dtype=np.int64)])
        return np.diff(total[words.first])


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit."""
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = held(("word counts", path), lambda: TokenCounter(path, whole.value))
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for a, b in blocks(offsets, BLOCK_BYTES):
                n = counter.block(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(offsets[a:b + 1])), pa.array(n)],
                    names=["doc_id", "n_bytes", "n_tokens"])

    return (docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
