"""Quality rule on repetition inside a text, by suffix array.

The words of a block of texts are sorted by suffix (prefix doubling; each round
only touches positions that are still tied, and texts never mix). The rank
arrays of the rounds give the longest common prefix of neighbours in the suffix
array. Each interval of that array is a maximal repeated substring; the longest
one that starts at a position reaches ``max`` of its two neighbour values. The
union of the spans of all repeats of at least ``MIN_WORDS`` words is the covered
part. A text fails if more than ``MAX_COVERED`` of its words are covered or its
longest repeat has more than ``MAX_REPEAT`` words.

Null or empty text has no words: every count is 0 and it fails the base rule.
Ids may be null or repeated, extra columns are ignored, an empty table gives an
empty result. Memory follows a block of texts or one very long text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textbatch import Words, blocks, buffers

MIN_WORDS = 6
MAX_COVERED = 0.2
MAX_REPEAT = 100
WINDOW = 8
BLOCK_BYTES = 2 << 20


def repeat_lengths(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each position, the words of the longest repeat that starts there
    (0 if the word occurs once in its text). ``word``: ids of equal words,
    ``first``: limits of the texts."""
    n = len(word)
    if not n:
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = np.asarray(first)[1:][doc]
    order = np.lexsort((word, doc))
    new = np.ones(n, dtype=bool)
    new[1:] = (word[order][1:] != word[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    rank = np.empty(n, np.int64)  # place in the suffix array of the first of the equals
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    array = order
    ranks, h = [rank.astype(np.int32)], 1
    while True:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))  # places in the array
        if not len(tied):
            break
        at = array[tied]
        nxt = at + h
        key = np.where(nxt < end[at], rank[np.minimum(nxt, n - 1)] + 1, 0)
        inner = np.lexsort((key, rank[at]))
        at, key, own = at[inner], key[inner], rank[at[inner]]
        array[tied] = at
        step = np.ones(len(tied), dtype=bool)
        step[1:] = (own[1:] != own[:-1]) | (key[1:] != key[:-1])
        new[tied] = step
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(step, tied, 0))
        h *= 2
        ranks.append(rank.astype(np.int32))
    # neighbours of the array that share at least their first word
    pair = np.flatnonzero(ranks[0][array[1:]] == ranks[0][array[:-1]])
    a, b = array[pair], array[pair + 1]
    room = np.minimum(end[a] - a, end[b] - b)
    common = np.zeros(len(pair), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        fits = common + (1 << k) <= room
        x, y = np.minimum(a + common, n - 1), np.minimum(b + common, n - 1)
        common += np.where(fits & (ranks[k][x] == ranks[k][y]), 1 << k, 0)
    longest = np.zeros(n, np.int64)
    longest[a] = common
    longest[b] = np.maximum(longest[b], common)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Positions inside the union of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def _per_text(mask: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[first])


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def profile(data: np.ndarray, offsets: np.ndarray, min_words: int, max_covered: float, max_repeat: int) -> dict[str, np.ndarray]:
    """The result columns (without doc_id) of a block of texts."""
    words = Words(data, offsets)
    n, first = words.counts, words.first
    longest = repeat_lengths(words.ids(), first)
    windows = np.flatnonzero(longest >= WINDOW)
    spans = np.flatnonzero(longest >= min_words)
    repeat_words = _per_text(covered(windows, np.full(len(windows), WINDOW), len(longest)), first)
    covered_words = _per_text(covered(spans, longest[spans], len(longest)), first)
    over = _per_text(longest > max_repeat, first) > 0
    raw = data.tobytes()
    lines = np.array([_repeated_lines(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], dtype=np.int64)
    base_failed = (n < 20) | (100 * repeat_words > 30 * n)
    return {"n_words": n, "word_chars": words.word_chars(), "n_symbols": words.symbols(), "n_dup_lines": lines,
            "n_repeat_words": repeat_words, "covered_words": covered_words, "long_repeat": over, "base_failed": base_failed,
            "kept": ~base_failed & ~over & ~(covered_words > max_covered * n)}


def repetition_rules(docs: DataFrame, min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED,
                     max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the base counts, covered_words,
    long_repeat, base_failed and kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for a, b in blocks(offsets, BLOCK_BYTES):
                out = profile(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], min_words, max_covered, max_repeat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(x) for x in out.values())],
                                                 names=["doc_id", *out])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "covered_words long, long_repeat boolean, base_failed boolean, kept boolean")
