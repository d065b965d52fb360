"""Near duplicates, license scan, sanitisation, line templates and toxicity on
small fixtures, and the corner rows through all of them and the pipeline."""

import random
import re
import sys
import os
from collections import Counter

import numpy as np
import pytest
from cases import SCHEMA, clashing, corner_rows, frame, prose
from pyspark.sql import functions as F

from trafficlens.llm import licenses, near_dedup, sanitise, templates, toxicity

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def bag(text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_near_classes_against_brute_force(spark):
    r = random.Random(1)
    texts = []
    for f in range(6):
        base = prose(f, 120, 5000).split(" ")
        for c in range(12):
            words = list(base)
            for _ in range(c % 4):
                words[r.randrange(len(words))] = f"edit{r.randrange(10**6)}"
            texts.append(" ".join(words))
    texts += [prose(100 + i, 90, 5000) for i in range(20)] + [None, "", "two words", "two  words"]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = {x.doc_id: x.class_id for x in near_dedup.near_duplicate_classes(clashing(frame(spark, rows))).collect()}
    bags = [bag(t) for t in texts]
    sure, never = 0, 0
    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j]:
                s = sum((bags[i] & bags[j]).values()) / sum((bags[i] | bags[j]).values())
                if s >= 0.85:  # clear of the IDF's small effect
                    sure += 1
                    assert got[i] == got[j]
                if s == 0:
                    never += got[i] == got[j]
    assert sure > 50 and never == 0


def test_large_family_equals_components_of_all_pairs(spark, monkeypatch):
    """Every pair that reaches the similarity is linked, however large its buckets."""
    r = random.Random(7)
    base, texts = prose(3, 110, 5000).split(" "), []
    for c in range(160):
        words = list(base)
        for at in r.sample(range(len(words)), c % 6):
            words[at] = f"edit{r.randrange(10**6)}"
        texts.append(" ".join(words))
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    got = {x.doc_id: x.class_id for x in near_dedup.near_duplicate_classes(docs).collect()}
    frequent, low = near_dedup.frequent_shingles(docs), list(range(len(texts)))
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    near = near_dedup.weighted_jaccard([texts[x].encode() for p in pairs for x in p], frequent) >= 0.8 - 1e-9
    for i, j in (p for p, hit in zip(pairs, near) if hit):
        a, b = sorted((low[i], low[j]))
        low = [a if x == b else x for x in low]
    assert 1 < len(set(low)) < len(texts)
    assert [got[i] for i in range(len(texts))] == low


def cells_of(spark, labels):
    """The cells of one bucket whose rows have these classes (None: a class alone)."""
    name = lambda i: i.to_bytes(16, "big")
    rows = [(1, 0, name(i), 100, b"", b"") for i in range(len(labels))]
    shared = spark.createDataFrame(rows, "bucket long, band int, fp binary, size long, keys binary, digest binary")
    known = spark.createDataFrame([(name(i), name(10**9 + x)) for i, x in enumerate(labels) if x is not None], "node binary, label binary")
    return near_dedup._cells(shared, known).select("low", "high", "block", "fp", "label").toPandas()


def test_one_stray_row_does_not_square_a_bucket(spark):
    got = cells_of(spark, [1] * 40_000 + [None])
    assert len(got) <= 2 * 40_001
    assert got.groupby("fp").size().max() <= 41


def test_rows_of_different_classes_meet_in_one_cell(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    labels = [1] * 150 + [2] * 40 + [3] * 3 + [None] * 17
    met = Counter()
    for _, cell in cells_of(spark, labels).groupby(["low", "high"]):
        rows = list(cell[["fp", "label", "block"]].itertuples(index=False))
        inner = cell["low"].iloc[0] == cell["high"].iloc[0]
        for i, x in enumerate(rows):
            for y in rows[:i]:
                if x.label != y.label and (inner or x.block != y.block):
                    met[frozenset((bytes(x.fp), bytes(y.fp)))] += 1
    sizes = Counter(x for x in labels if x is not None)
    n = len(labels)
    different = (n * (n - 1) - sum(k * (k - 1) for k in sizes.values())) // 2
    assert len(met) == different and set(met.values()) == {1}


def test_weighted_jaccard():
    a, b = prose(1, 60), prose(1, 60).replace("w1", "x", 1)
    x, y = bag(a), bag(b)
    want = sum((x & y).values()) / sum((x | y).values())
    assert np.allclose(near_dedup.weighted_jaccard([a.encode(), b.encode(), a.encode(), b""], None), [want, 0])


def test_license_matches(spark):
    line = licenses.TEMPLATES["mit-line"]
    rows = [(1, "alpha beta " * 7 + line + " gamma", "", "", 1), (2, "x. " + line.upper(), "", "", 1), (2, "x. " + line.upper(), "", "", 1),
            (3, "released under the licence of mit", "", "", 1), (None, licenses.TEMPLATES["apache-2.0-notice"].replace("obtain", "get"), "", "", 1),
            (5, None, "", "", 1)]
    got = {(r.doc_id, r.template, r.start_word) for r in licenses.license_matches(clashing(frame(spark, rows))).collect()}
    assert got == {(1, "mit-line", 14), (2, "mit-line", 1), (None, "apache-2.0-notice", 0), (None, "apache-2.0-line", 0)}


def test_sanitise(spark):
    secret = ["Zebulon", "keeps", "it"]
    rows = [(i, f"{prose(i, 30)} {secret[0]} wrote to ann.lee@example.org {prose(50 + i, 30)}", "", "", 1) for i in range(5)]
    rows += [(10 + i, prose(200 + i, 60), "", "", 1) for i in range(200)]
    rows += [(900, "call +1 (415) 555-0100 or 4111 1111 1111 1111 at 10.0.0.256 and 10.0.0.1", "", "", 1), (901, None, "", "", 1)]
    docs = clashing(frame(spark, rows))
    got = {r.doc_id: r for r in sanitise.personal_data(docs).collect()}
    assert (got[900].n_email, got[900].n_ip, got[900].n_card, got[900].n_phone) == (0, 1, 1, 1)
    assert got[901].spans == ""
    text = dict((r[0], r[1]) for r in rows)
    for i in range(5):
        terms = {text[i][int(a):int(b)] for k, a, b in (s.split(":") for s in got[i].spans.split(",")) if k == "term"}
        assert "Zebulon" in terms
    clean = sanitise.sanitise(docs)
    assert clean.columns == docs.columns
    new = {r.doc_id: r.text for r in clean.collect()}
    assert "[EMAIL]" in new[0] and "ann.lee" not in new[0] and "[NAME]" in new[0]
    assert new[900] == "call [PHONE] or [CARD] at 10.0.0.256 and [IP]" and new[901] is None
    assert all(new[10 + i] == text[10 + i] for i in range(200))


def test_short_and_added_license_templates(spark):
    rows = [(1, "one two. ALL RIGHTS\nreserved. three all rights reserved", "", "", 1), (2, "all rights are reserved", "", "", 1),
            (2, "all rights", "", "", 1), (None, "All rights reserved.", "", "", 1), (None, "All rights reserved.", "", "", 1), (4, None, "", "", 1)]
    names = ["isc-grant", "mit-disclaimer", "bsd-disclaimer", "gpl-warranty", "lgpl-notice", "cc-by-sa-4.0-line", "cc0-line", "unlicense-line"]
    rows += [(10 + i, f"alpha beta {licenses.TEMPLATES[n]} gamma", "", "", 1) for i, n in enumerate(names)]
    docs = clashing(frame(spark, rows))
    got = [(r.doc_id, r.template, r.start_word, r.places) for r in licenses.license_matches(docs).collect()]
    assert sorted(x[1:] for x in got if x[1] == "all-rights-reserved" and x[0] is None) == [("all-rights-reserved", 0, 1)]
    assert (1, "all-rights-reserved", 2, 2) in got and not any(x[0] in (2, 4) for x in got)
    assert all((10 + i, n, 2) in {x[:3] for x in got} for i, n in enumerate(names))
    alone = licenses.license_matches(docs, {"arr": "All rights reserved."}).collect()
    assert sorted(r.doc_id or 0 for r in alone) == [0, 1]


def _marked_terms(docs, texts):
    return {r.doc_id: [texts[r.doc_id][int(a):int(b)] for k, a, b in (x.split(":") for x in r.spans.split(",") if x) if k == "term"]
            for r in sanitise.personal_data(docs).where("doc_id < 100").collect()}


def test_terms_are_counted_over_distinct_texts(spark):
    texts = {i: f"{prose(i, 12)} Zebulon wrote to ann.lee@example.org {prose(50 + i, 12)}" for i in range(3)}
    rows = [(i, t, "", "", 1) for i, t in texts.items()] + [(100 + i, texts[0], "", "", 1) for i in range(60)]
    rows += [(200 + i, prose(200 + i, 20), "", "", 1) for i in range(120)]
    got = _marked_terms(frame(spark, rows), texts)
    assert all("Zebulon" in got[i] for i in range(3))


def test_terms_far_from_their_entity(spark):
    texts = {i: f"Zebulon\n{prose(i, 90)} mail ann.lee@example.org {prose(50 + i, 90)} Zebulon, again ZEBULON." for i in range(4)}
    texts[4] = f"from {prose(9, 20)} zebulon"  # without the entity
    rows = [(i, t, "", "", 1) for i, t in texts.items()] + [(200 + i, prose(200 + i, 60), "", "", 1) for i in range(200)]
    docs = frame(spark, rows)
    got = _marked_terms(docs, texts)
    assert all([w for w in got[i] if w.lower() == "zebulon"] == ["Zebulon", "Zebulon", "ZEBULON"] for i in range(4)) and got[4] == []
    new = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert all("zebulon" not in new[i].lower() and "[EMAIL]" in new[i] for i in range(4)) and new[4] == texts[4]


def test_templates(spark):
    rows = [(i, f"{prose(i, 9).replace(chr(10), ' ')}\nuser {i} logged in from host{i}\nsame footer on every page\nshort", "", "", 1) for i in range(8)]
    rows += [(50, "a line of its own", "", "", 1), (51, None, "", "", 1)]
    docs = clashing(frame(spark, rows))
    new = {r.doc_id: r.text for r in templates.drop_template_lines(docs).collect()}
    for i in range(8):
        assert new[i] == rows[i][1].split("\n")[0] + "\nshort"
    assert new[50] == "a line of its own" and new[51] is None
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in templates.template_report(docs).collect()}
    assert got[0] == (4, 2) and got[51] == (0, 0)


def test_lines_that_only_open_alike_stay(spark):
    words = "amber birch cedar delta ember frost grove heath".split()
    rows = [(i, f"This is the {w}\nHe said that {w} {w}s\nThor the haan {w} of {w}s\nkeep", "", "", 1) for i, w in enumerate(words)]
    rows += [(100 + i, f"please contact the {w} desk before you open a case", "", "", 1) for i, w in enumerate(words)]
    new = {r.doc_id: r.text for r in templates.drop_template_lines(frame(spark, rows)).collect()}
    assert all(new[i] == rows[i][1] for i in range(len(words)))
    assert all(new[100 + i] == "" for i in range(len(words)))


def test_templates_recur_whatever_else_their_leaf_holds(spark):
    """Against all sets of open places of each line, in plain Python."""
    from itertools import combinations
    r = random.Random(5)
    name = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    lines = [f"please write to {name()} for help with orders" for _ in range(6)]
    lines += [f"please write to our {name()} desk for {name()}" for _ in range(6)]
    lines += [f"please write to support about your {name()} {name()}" for _ in range(3)]  # too few texts
    lines += ["please write to " + " ".join(name() for _ in range(5)) for _ in range(120)]
    lines += ["please write to " + " ".join(r.choice("xyz") for _ in range(5)) for _ in range(30)]
    lines = list(dict.fromkeys(lines))  # copies of a text count as one
    found, holds = set(), {}
    for i, line in enumerate(lines):
        words = line.split(" ")
        for k in range(3):
            for wild in combinations(range(3, 8), k):
                holds.setdefault(tuple("*" if at in wild else w for at, w in enumerate(words)), set()).add(i)
    for texts in holds.values():
        if len(texts) >= templates.RECURS:
            found.update(texts)
    docs = frame(spark, [(i, line, "", "", 1) for i, line in enumerate(lines)])
    new = {x.doc_id: x.text for x in templates.drop_template_lines(docs).collect()}
    assert {i for i, t in new.items() if t == ""} == found
    assert set(range(12)) <= found and not found & set(range(12, 135))


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels


def test_toxicity_held_out(learned):
    docs, labels = learned
    rows = toxicity.toxicity_scores(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic", "score").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.93
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits / sum(r.toxic for r in rows) > 0.75 and hits / sum(r.predicted for r in rows) > 0.9


def test_drop_toxic_keeps_the_columns_of_what_scores_low(learned):
    docs, labels = learned
    part = clashing(docs.where("doc_id < 3000"))
    out = toxicity.drop_toxic(part, labels)
    assert out.columns == part.columns
    known = toxicity.fit(part.select("doc_id", "text"), labels).score(part.select("doc_id", "text"))
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.c0 for r in known.where("p < 0.5").collect())


def test_corner_rows_and_empty_tables(spark):
    rows = corner_rows()
    docs, empty = clashing(frame(spark, rows)), spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, None)], "doc_id long, toxic int")
    per_row = [near_dedup.near_duplicate_classes, sanitise.personal_data, templates.template_report, lambda d: toxicity.toxicity_scores(d, labels)]
    for f in per_row:
        assert f(docs).count() == len(rows) and f(empty).count() == 0
    for f in (near_dedup.drop_near_copies, sanitise.sanitise):
        assert f(docs).columns == docs.columns and f(empty).count() == 0
    assert licenses.license_matches(empty).count() == 0
    licenses.license_matches(docs).collect()


def test_pipeline(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert 0.7 * docs.count() < len(ids) <= docs.count()
    fills = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert fills.where("n > 2048 or n != end").isEmpty()
