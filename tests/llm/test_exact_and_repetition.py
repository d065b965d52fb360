"""Exact groups and the repetition rule against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from cases import BLANK, SCHEMA, clashing, corner_rows, frame, odd_texts, prose

from trafficlens.llm import exact_dedup, repetition


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    copies = [(1000 + i, r.choice(["hot text  here", "hot text\nhere", "hot\ttext here"]), "en", "s", 1) for i in range(400)]
    return corner_rows() + copies


def norm(text):
    return BLANK.sub(" ", text or "")


def groups(rows):
    out = defaultdict(list)
    for r in rows:
        out[norm(r[1])].append(r[0])
    return out


def test_groups(spark, rows):
    got = exact_dedup.duplicate_groups(clashing(frame(spark, rows, parts=7))).collect()
    by = groups(rows)
    want, left = Counter(), {}
    for doc_id, text, *_ in rows:
        ids = [i for i in by[norm(text)] if i is not None]
        want[(doc_id, min(ids, default=None), len(by[norm(text)]), hashlib.sha256(norm(text).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    for r in got:
        if r.kept:
            assert r.doc_id == r.keep_id
            left[r.text_sha256] = left.get(r.text_sha256, 0) + 1
    assert len(left) == len(by) and set(left.values()) == {1}


def test_drop_copies_keeps_one_row_with_its_columns(spark, rows):
    docs = clashing(frame(spark, rows, parts=7))
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    got = out.collect()
    by = groups(rows)
    assert Counter(norm(r.text) for r in got) == Counter(by.keys())
    for r in got:
        ids = [i for i in by[norm(r.text)] if i is not None]
        assert r.doc_id == min(ids, default=None)


def brute_repetition(text, min_words, max_covered, max_repeat):
    words = [w for w in BLANK.split(text or "") if w]
    n = len(words)

    def cover(size):
        seen = defaultdict(list)
        for i in range(n - size + 1):
            seen[tuple(words[i:i + size])].append(i)
        return {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + size)}

    again = len(cover(8))
    covered = len(cover(min_words))
    over = bool(cover(max_repeat + 1))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if BLANK.sub("", line):
            dup += line in seen
            seen.add(line)
    failed = n < 20 or 100 * again > 30 * n
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return (n, sum(map(len, words)), symbols, dup, again, covered, over, failed,
            not failed and not over and not covered > max_covered * n)


def test_repetition_against_brute_force(spark):
    r = random.Random(5)
    texts = odd_texts(9, 40) + [prose(i, 120, 5 + 10 * i) for i in range(12)]
    passage = prose(77, 60, 5000)
    texts += [passage + "\n" + prose(78 + i, 50 * i, 5000) + "\n" + passage for i in range(6)] + [None, "", "a " * 300, "a b " * 99]
    texts += ["x y z\nx y z\n\n \n x y z\nx y z"] * 2
    r.shuffle(texts)
    rows = [(i if i % 7 else None, t, "en", "s", 1) for i, t in enumerate(texts)]
    for args in ((6, 0.2, 100), (3, 0.1, 12)):
        got = repetition.repetition_rules(clashing(frame(spark, rows, parts=4)), *args).collect()
        want = sorted(repr((i, *brute_repetition(t, *args))) for i, t, *_ in rows)
        assert sorted(repr(tuple(g)) for g in got) == want


def test_corner_rows_and_empty_table(spark, rows):
    assert repetition.repetition_rules(frame(spark, rows)).count() == len(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert repetition.repetition_rules(empty).count() == 0
    assert exact_dedup.duplicate_groups(empty).count() == 0
    assert exact_dedup.drop_copies(empty).columns == empty.columns
    assert exact_dedup.drop_copies(empty).count() == 0
