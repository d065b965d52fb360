"""Encoders, counts and packing against the libraries."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from cases import SCHEMA, clashing, corner_rows, frame

from trafficlens.llm import byte_bpe, packing, token_counts, wordbpe

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def rows():
    return corner_rows()


def multiset(rows):
    return sorted(map(repr, rows))


def test_byte_codec_matches_the_library(spark, rows):
    with open(BYTE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = byte_bpe.round_trip_digests(clashing(frame(spark, rows)), BYTE, P.PATTERN)
    got = multiset(tuple(r) for r in out.collect())
    want = []
    for doc_id, text, *_ in rows:
        ids = lib.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == multiset(want)


def test_byte_ids_round_trip(spark, rows):
    docs = frame(spark, rows)
    back = byte_bpe.decode_ids(byte_bpe.encode_texts(docs, BYTE, P.PATTERN), BYTE, P.PATTERN)
    assert multiset((r[0], bytes(r[1]).decode()) for r in back.collect()) == multiset((r[0], r[1] or "") for r in rows)


def test_long_run_of_one_pre_token():
    codec = byte_bpe.ByteCodec(BYTE, P.PATTERN)
    with open(BYTE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("ab" * 1500, "qzxj" * 700, "é" * 900):
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, _ = codec.encode(raw, np.array([0, len(raw)]))
        assert ids.tolist() == lib.encode_ordinary(text)


def test_full_memory_changes_nothing(rows):
    texts = [r[1] or "" for r in rows]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    wide, narrow = wordbpe.WordEncoder(WORD), wordbpe.WordEncoder(WORD)
    narrow.table = wordbpe.ChunkTable(narrow._compute, entries=7)
    narrow.pieces.memory = 3
    for _ in range(2):
        a, b = wide.block(raw, offsets), narrow.block(raw, offsets)
        assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])


def test_token_counts_match_the_library(spark, rows):
    lib = wordbpe.library(WORD)
    out = token_counts.token_counts(clashing(frame(spark, rows)), WORD)
    want = []
    for doc_id, text, *_ in rows:
        n = len(lib.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 2048))
    assert multiset(tuple(r) for r in out.collect()) == multiset(want)


def test_proven_tokens_are_single():
    proven = token_counts.prove_whole_tokens(WORD)
    lib = wordbpe.library(WORD)
    assert len(proven) > 10_000
    for text in sorted(w for w in proven if w.isascii() and w.isalpha())[::50]:
        assert len(lib.encode(text, add_special_tokens=False).ids) == 1


def check_packing(rows, pieces, capacity=packing.CAPACITY):
    lib = wordbpe.library(WORD)
    want = []
    for doc_id, text, *_ in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[a:a + capacity], dtype="<u4")
            want.append((doc_id, k, a, len(part), zlib.crc32(part.tobytes())))
    assert multiset((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == multiset(want)
    bins = defaultdict(list)
    for r in pieces:
        bins[r.sequence_id].append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_is_whole_and_tight(spark, rows):
    pieces = packing.pack(clashing(frame(spark, rows, parts=20)), WORD).collect()
    n = check_packing(rows, pieces)
    one = packing.best_fit(np.array([r.length for r in pieces]), packing.CAPACITY)[2]
    assert n <= len(one) + 1


def test_packing_hands_on_as_if_all_bins(spark, monkeypatch):
    """Bounded by fill and rounds left, a node's bins pack as if it handed on all of them."""
    r = np.random.default_rng(1)
    # per node many bins of the same few fills, and one small item that finds its place later
    sizes = np.concatenate([r.choice([1100, 1300, 1500, 1700], 400), r.integers(1, 1000, 32)])
    r.shuffle(sizes)
    rows = [(i, " ".join(["the"] * int(n - 1))) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(32)
    fills = lambda pieces: sorted(sum(p.length for p in g) for g in by_sequence(pieces).values())
    bounded = packing.pack(docs, WORD, fan_in=2).collect()
    check_packing(rows, bounded)
    merged, most = packing._merged, []
    monkeypatch.setattr(packing, "_merged", lambda bins, capacity, n, full: (most.append(n), merged(bins, capacity, 1 << 40, full))[1])
    whole = packing.pack(docs, WORD, fan_in=2).collect()
    assert most == [8, 6, 4, 2, 0] and fills(bounded) == fills(whole)


def by_sequence(pieces):
    out = {}
    for p in pieces:
        out.setdefault(p.sequence_id, []).append(p)
    return out


def test_best_fit():
    r = np.random.default_rng(0)
    lengths = r.integers(1, 2049, 3000)
    bins, places, fills = packing.best_fit(lengths, 2048)
    assert fills.max() <= 2048 and fills.sum() == lengths.sum()
    assert np.array_equal(np.bincount(bins, lengths), fills)
    assert len(fills) <= 1.03 * max(np.ceil(lengths.sum() / 2048), (lengths > 1024).sum())
    assert len(set(zip(bins.tolist(), places.tolist()))) == len(lengths)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack(empty, WORD).count() == 0
    assert token_counts.token_counts(empty, WORD).count() == 0
    assert byte_bpe.round_trip_digests(empty, BYTE, P.PATTERN).count() == 0
