"""Equality behind the hashes: strings that collide under polynomial hashes modulo
2^64 whatever the base (Thue-Morse strings and their complements)."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as tokenizers
import pytest
from cases import SCHEMA, frame
from tokenizers import Tokenizer

from trafficlens.llm import byte_bpe, near_dedup, packing, repetition, textbatch, token_counts
from trafficlens.llm.chunktable import ChunkTable


def thue_morse(n, a, b):
    return "".join(a if i.bit_count() % 2 == 0 else b for i in range(n))


def twins(n, a="a", b="b"):
    return thue_morse(n, a, b), thue_morse(n, b, a)


def rows(texts):
    return [(i + 1, t, None, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("letters", ["ab", "a7"])
def test_codecs_tell_twins_apart(spark, letters):
    texts = [t for n in (1024, 2048) for t in twins(n, *letters)]
    docs = frame(spark, rows(texts), parts=1)
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    got = {r.doc_id: r.decoded_sha256 for r in byte_bpe.round_trip_digests(docs, path, tokenizers.PATTERN).collect()}
    assert got == {i + 1: hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts)}
    path = tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [r.n_tokens for r in token_counts.token_counts(docs, path).orderBy("doc_id").collect()] == want
    packed = packing.pack(docs, path).collect()
    import zlib
    for r in packed:
        ids = library.encode(texts[r.doc_id - 1], add_special_tokens=False).ids + [0]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())


def test_twins_are_no_copies(spark):
    a, b = twins(1024)
    common = " ".join(f"w{i}" for i in range(4))
    docs = frame(spark, rows([f"{a} {common}", f"{b} {common}"]), parts=1)
    assert {r.class_id for r in near_dedup.near_duplicate_classes(docs).collect()} == {1, 2}
    assert near_dedup.drop_near_copies(docs).count() == 2


def test_twins_are_no_repeat(spark):
    a, b = twins(1024)
    words = [f"w{i}" for i in range(7)]
    text = " ".join([a, *words, "x1", "x2", b, *words, *(f"y{i}" for i in range(20))])
    got = repetition.repetition_rules(frame(spark, rows([text]), parts=1)).collect()[0]
    assert got.n_repeat_words == 0 and not got.base_failed


def test_ids_are_exact_under_equal_hashes(monkeypatch):
    data = "aa bb aa cccccccccccc bb cccccccccccd aa".encode()
    flat = np.frombuffer(data, np.uint8)
    words = textbatch.Words(flat, np.array([0, len(data)]))
    spans = list(zip(words.start.tolist(), words.end.tolist()))
    want = [data[a:b] for a, b in spans]

    def check(ids):
        return len(set(zip(ids.tolist(), want))) == len(set(ids.tolist())) == len(set(want))

    assert check(words.ids())
    monkeypatch.setattr(textbatch, "span_hashes", lambda d, s, e, seeds=1: np.zeros((seeds, len(s)), np.uint64))
    assert check(words.ids())


def test_table_asks_both_hashes(monkeypatch):
    from trafficlens.llm import chunktable
    data = " ".join(f"w{i % 300}" for i in range(2000)).encode()
    flat = np.frombuffer(data, np.uint8)
    words = textbatch.Words(flat, np.array([0, len(data)]))
    full = textbatch.span_hashes

    def weak(d, s, e, seeds=1):  # the first hash has three values
        h = full(d, s, e, seeds)
        h[0] = h[0] % np.uint64(3) << np.uint64(62)
        return h

    monkeypatch.setattr(chunktable, "span_hashes", weak)
    table = ChunkTable(lambda chunks: [int(c[1:]).to_bytes(4, "little") for c in chunks], entries=400)
    for _ in range(2):
        first, size, values = table.lookup(flat, words.start, words.end)
        assert (values[first] == [i % 300 for i in range(2000)]).all() and (size == 1).all()


def test_hashes_of_many_spans():
    g = np.random.default_rng(0)
    data = g.integers(97, 99, 40_000).astype(np.uint8)
    start = np.sort(g.choice(39_000, 3000, replace=False))
    end = start + g.integers(0, 40, 3000)
    one, two = textbatch.span_hashes(data, start, end, 2)
    texts = [data[a:b].tobytes() for a, b in zip(start, end)]
    for h in (one, two):
        assert len(set(zip(h.tolist(), texts))) == len(set(h.tolist())) == len(set(texts))
    assert Counter(textbatch.exact_ids(data, start, end).tolist()).most_common(1)[0][1] == Counter(texts).most_common(1)[0][1]


def test_empty_frame(spark):
    assert repetition.repetition_rules(spark.createDataFrame([], SCHEMA)).collect() == []
