"""op5 against plain Python: base spans of a whole table, disclosing terms and
replacements by counting everything, spans of long texts in linear time."""

import hashlib
import random
import re
import time
from collections import defaultdict
from math import log2

import regex
from cases import frame, prose
from pyspark.sql import functions as F

from trafficlens.llm import sanitise, spans

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def passes(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return sorted((m.start(), rank, m.end(), m.group()) for rank, (kind, p) in enumerate(PATTERNS)
                  for m in re.finditer(p, text) if passes(kind, m.group()))


def brute_terms(texts):
    """For each distinct text the places of its disclosing terms."""
    texts = set(texts)
    found, n_term = {t: base(t) for t in texts}, defaultdict(int)
    places = {t: [(m.start(), m.end(), m.group().lower()) for m in regex.finditer(r"[\p{L}\p{N}]+", t)] for t in texts}
    for t in texts:
        for w in {w for _, _, w in places[t] if len(w) >= 3}:
            n_term[w] += 1
    contexts, holders = defaultdict(dict), defaultdict(set)
    for t in texts:
        for a, rank, b, v in found[t]:
            entity = (rank, re.sub("[^0-9]", "", v) if rank >= 2 else v.lower())
            holders[entity].add(t)
            near, key = (t[max(0, a - sanitise.REACH):a], t[b:b + sanitise.REACH]), hashlib.sha256(t.encode()).hexdigest()
            contexts[entity][near] = min(contexts[entity].get(near, (key, t)), (key, t))
    free = {t: [p for p in places[t] if not any(a < p[1] and p[0] < b for a, _, b, _ in found[t])] for t in texts}
    marks = defaultdict(set)
    for entity, by_context in contexts.items():
        held = {t for _, t in by_context.values()}
        if len(held) < sanitise.SUPPORT:
            continue
        both = defaultdict(int)
        for t in held:
            for w in {w for _, _, w in free[t] if len(w) >= 3}:
                both[w] += 1
        ic = log2(len(texts) / len(held))
        wanted = {w for w, n in both.items() if n >= sanitise.SUPPORT
                  and (pmi := log2(n * len(texts) / (len(held) * n_term[w]))) > 0 and pmi >= sanitise.DISCLOSURE * ic}
        for t in holders[entity]:
            marks[t].update((a, 4, b) for a, b, w in free[t] if w in wanted)
    return found, marks


def mail_texts():
    r, out = random.Random(4), []
    people = [(f"Name{chr(97 + i)}", f"u{i}@mail{i % 3}.org", f"+1 (415) 555-01{i:02}") for i in range(12)]
    for i in range(260):
        words = prose(i, 40, 300).split(" ")
        for name, mail, phone in r.sample(people, r.choice([0, 0, 1, 2])):
            for extra in (name, mail, "the", r.choice([phone, name.upper(), "10.0.0.7"])):
                words.insert(r.randrange(len(words) + 1), extra)
        out.append(" ".join(words) + " \U0001F600 end")
    return out + out[:40] + ["", "x" * 3000, "a@b.co" + "c" * 700 + " 10.0.0.7", "\U0001F600" * 600 + " u1@mail1.org"]


def test_base_spans_equal_python_over_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.select("text", sanitise.base_spans(F.col("text")).alias("spans")).collect()
    assert len(rows) > 900
    for r in rows:
        assert [tuple(s) for s in r.spans] == base(r.text)


NAMES = [*(k for k, _ in PATTERNS), "term"]


def brute_clean(text, want):
    out, at = "", 0
    for a, k, b in want:
        if a >= at:
            general = "[NUMBER]" if re.search("[0-9]", text[a:b]) else "[NAME]" if regex.match(r"\p{Lu}", text[a:b]) else ""
            out += text[at:a] + (f"[{NAMES[k].upper()}]" if k < 4 else general)
        at = max(at, b)
    return out + text[at:]


def brute_spans(texts):
    """All spans of each distinct text, by start, then kind."""
    found, marks = brute_terms(texts)
    return {t: sorted([s[:3] for s in found[t]] + list(marks[t])) for t in found}


def test_terms_and_replacements_against_counting_everything(spark):
    texts = mail_texts()
    docs = frame(spark, [(i, t, "", "", 1) for i, t in enumerate(texts)])
    want = brute_spans(texts)
    assert sum(k == 4 for spans_ in want.values() for _, k, _ in spans_) > 50
    cleaned = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    for r in sanitise.personal_data(docs).collect():
        t = texts[r.doc_id]
        assert r.spans == ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in want[t])
        assert cleaned[r.doc_id] == brute_clean(t, want[t])


def test_cut_and_running_max(spark):
    r = random.Random(2)
    text = "".join(r.choice("ab\n\U0001F600é") for _ in range(2000))
    rows = [(text, a, a + r.randrange(0, 700)) for a in [0, 1, 255, 256, 257, 511, 1999, 2000] + [r.randrange(2000) for _ in range(40)]]
    got = spark.createDataFrame(rows, "t string, a int, b int").select("a", "b", spans.cut(spans.blocks(F.col("t")), F.col("a"), F.col("b")).alias("x"))
    assert all(x.x == text[x.a:x.b] for x in got.collect())
    values = [[], [3], [0, 0], [r.randrange(10**6) for _ in range(5000)]]
    got = spark.createDataFrame([(v,) for v in values], "v array<int>").select("v", spans.running_max(F.col("v")).alias("m"))
    assert all(x.m == [max(x.v[:i + 1]) for i in range(len(x.v))][:len(x.v)] for x in got.collect())


def test_long_texts_take_linear_time(spark):
    def seconds(n):
        text = " ".join(f"w{i} p{i}.q@example{i % 7}.org hello there" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string").cache()
        docs.count()
        t = time.time()
        got = docs.withColumn("spans", sanitise.base_spans(F.col("text"))).select(
            F.size("spans"), F.length(sanitise._cleaned(F.col("text"), F.col("spans")))).first()
        assert got[0] == n
        return time.time() - t
    seconds(1000)
    assert seconds(32_000) < 2.5 * max(seconds(16_000), 1.0)
