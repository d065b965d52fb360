"""Document frequencies and weights of op2, and the last places of a bin of op9."""

import public_tokenizers
from cases import frame, prose

from trafficlens.llm import near_dedup, packing
from trafficlens.llm.near_dedup import frequent_shingles


def test_common_shingles_weigh_little(spark):
    """Long common text with short texts of their own: nearly equal by plain counts, not by TF-IDF."""
    common = prose(1, 300, 5000)
    docs = frame(spark, [(i, f"{common} {prose(100 + i, 20, 5000)}", "en", "s", 1) for i in range(60)])
    got = near_dedup.near_duplicate_classes(docs).collect()
    assert {r.class_id for r in got} == set(range(60)) and {r.class_size for r in got} == {1}


def test_document_frequencies_do_not_depend_on_partitions(spark):
    common, pair = prose(1, 40, 5000), prose(2, 30, 5000)
    rows = [(i, f"{common} {prose(100 + i, 20, 5000)}" + (f" {pair}" if i in (3, 17) else ""), "en", "s", 1) for i in range(40)]
    one, each = (frequent_shingles(frame(spark, rows).repartition(n)) for n in (1, 40))
    assert list(one.keys) == list(each.keys) and list(one.values) == list(each.values)
    assert len(one.keys) >= 36 + 26 and len(set(one.values.tolist())) == 2


def test_second_pass_counts_what_windows_keep_back(spark, monkeypatch):
    rows = [(i, f"{prose(1, 12, 5000) if i % 50 == 0 else ''} {prose(100 + i, 8, 5000)}", "en", "s", 1) for i in range(2400)]
    docs = frame(spark, rows).repartition(2, "doc_id")
    keys, counts, documents, whole = near_dedup._candidates(docs)
    assert documents == 2400 and not whole
    exact = near_dedup._counted(docs, near_dedup.np.sort(keys))[1]
    assert sorted(exact.tolist())[-8:] == [48] * 8
    assert len(frequent_shingles(docs).keys) == 8


def handed_on(monkeypatch, docs):
    """(rows of the window sums, frequent shingles) of the documents."""
    made, plain = [], type(docs).mapInArrow
    with monkeypatch.context() as m:
        m.setattr(type(docs), "mapInArrow", lambda *a, **k: (made.append(plain(*a, **k)), made[-1])[1])
        found = frequent_shingles(docs)
    return made[0].count(), found


def in_parts(spark, texts, cuts):
    """The texts in as many partitions as there are ``cuts``, of these numbers of rows."""
    limits = near_dedup.np.cumsum(cuts)
    rows = [(int(near_dedup.np.searchsorted(limits, i, "right")), t) for i, t in enumerate(texts)]
    dealt = spark.sparkContext.parallelize(rows, 8).partitionBy(len(cuts), lambda part: part).values().map(lambda t: (t,))
    return dealt.toDF("text string").cache()


def test_small_partitions_hand_on_no_more_than_large_ones(spark, monkeypatch):
    """Documents that share a line, in 64 partitions: once, all of their shingles went on to the sums."""
    common = prose(1, 12, 5000)
    texts = [f"{common if i % 4 == 0 else ''} {prose(100 + i, 12, 5000)}" for i in range(4200)]
    rows, found = handed_on(monkeypatch, in_parts(spark, texts, [66] * 40 + [65] * 24))
    few, same = handed_on(monkeypatch, in_parts(spark, texts, [2100, 2100]))
    assert rows <= 2 * few < 200
    assert list(found.keys) == list(same.keys) and list(found.values) == list(same.values) and len(found.keys) == 8


def test_frequencies_are_exact_however_uneven_the_partitions(spark, monkeypatch):
    """Shingles at and just under the least frequency, in partitions of 1 to 2,400 documents."""
    cuts = [1] * 30 + [2400, 20, 0, 700, 3, 1500] + [10] * 60
    n = sum(cuts)
    lines = [(prose(k, 9, 5000), -(-n // near_dedup.RARE) + k % 3 - 1) for k in range(30)]
    texts = [prose(100 + i, 7, 5000) for i in range(n)]
    for k, (line, times) in enumerate(lines):
        for j in range(times):
            at = (j * (n // times) + 37 * k) % n if k % 2 else (n - 1 - j - 20 * k) % n
            texts[at] += f" {line}"
    raw = [t.encode() for t in texts]
    key = near_dedup._bags(raw, None)[0]
    keys, counts = near_dedup.np.unique(key, return_counts=True)
    often = counts >= n / near_dedup.RARE
    docs = in_parts(spark, texts, cuts)
    want = near_dedup.Frequent(keys[often], counts[often], n)
    assert 60 < len(want.keys) < 30 * 5
    for task_bytes in (near_dedup.TASK_BYTES, 1):
        monkeypatch.setattr(near_dedup, "TASK_BYTES", task_bytes)
        found = frequent_shingles(docs)
        assert list(found.keys) == list(want.keys) and list(found.values) == list(want.values)


def test_a_bin_takes_pieces_until_it_is_full(spark):
    texts = [" ".join(["the"] * (2040 - 1)), " ".join(["the"] * (8 - 1))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartitionByRange(2, "doc_id")
    got = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted((r.length, r.offset) for r in got) == [(8, 2040), (2040, 0)]
    assert len({r.sequence_id for r in got}) == 1
