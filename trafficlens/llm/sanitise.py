"""Personal data: base spans by pattern, and information-theoretic sanitisation.

Base kinds (leftmost, not overlapping, per kind; matches that fail their check
are dropped, without retries): email, ip (parts at most 255), card (12 to 19
digits that pass Luhn) and phone (9 to 15 digits).

Terms: each base span is an occurrence of a protected entity (its kind and
normalised value). Words (runs of letters and digits, lower case) of three
characters and more are terms; those that touch a base span are not looked at.
All terms of a text co-occur with each of its entities, however far they stand.
Over the N distinct texts of the corpus

    PMI(entity, term) = log2( n(entity, term) * N / (n(entity) * n(term)) )

estimates how many bits a term tells about the entity, whose own information is
IC(entity) = log2( N / n(entity) ). All counts are of distinct texts, so copies
count once; n(entity) and n(entity, term) take only one text of those where the
``REACH`` characters on either side of the entity repeat word for word. A term
that was seen with the entity in at least ``SUPPORT`` such texts and whose PMI
reaches ``DISCLOSURE`` of IC discloses it; every occurrence in the texts that
hold the entity becomes a span of kind ``term``. In the cleaned
text terms are generalised ([NUMBER] where they have a digit, [NAME] where they
are capitalised) or else removed, and base spans become [EMAIL] and so on.

Only DataFrame functions. Everything is counted by shuffled aggregations with
map-side sums; nothing is collected but the number of texts. Only entities and
terms of ``SUPPORT`` texts or more are paired, and of these only where the term is
rare enough: n(entity, term) is at most n(entity), so a term of more than
N^(1 - DISCLOSURE) * n(entity)^DISCLOSURE texts can't reach the threshold, whatever
the pair's count. Common words drop out before they meet an entity, and no pair is
lost. Texts meet the terms found by the digest of the text, so texts move only where
they hold such entities. Copies are told by 64-bit hashes when terms are counted.
Within a text, work grows with its length and (terms left) x (entities): spans,
surroundings, places and replacements take linear time (``spans.py``).

Null text counts as empty: no spans. Rows may repeat ids or have none: spans
depend on the text alone. Extra columns are kept by ``sanitise``. Empty in,
empty out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import spans as sp
from .secrets import matches

SUPPORT = 3
DISCLOSURE = 0.8
REACH = 256
BROADCAST_BYTES = 32 << 20
_HOLE = "\ua66e"  # a letter
SPANS = "array<struct<start:int,rank:int,end:int,value:string>>"
KINDS = ("email", "ip", "card", "phone", "term")

# The base patterns. Quantifiers are possessive and look-behinds
# skip starts inside a run where that can't change a match, so that long runs
# take linear time and no stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
WORD = r"[\p{L}\p{N}]++"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled, ends in 0."""
    reverse = F.split(F.reverse(digits), "")
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + F.when(
        i % 2 == 0, F.get(reverse, i).cast("int")).otherwise(
            F.get(reverse, i).cast("int") * 2 - F.when(F.get(reverse, i).cast("int") > 4, 9).otherwise(0)))
    return total % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    digits = _digits(value)
    n = F.length(digits)
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(12, 19), _luhn(digits)).otherwise(False)


def _valid(kind: str):
    return lambda s: _passes(kind, s["value"])


def _typed(rank: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), s["value"].alias("value"))


def _of_rank(rank: int):
    return lambda s: s["rank"] == rank


def base_spans(text: Column) -> Column:
    """array<(start, rank, end, value)> of all base spans, by start, then kind."""
    parts = []
    for rank, kind in enumerate(PATTERNS):
        hint = F.lit(True) if HINTS[kind] is None else F.contains(text, F.lit(HINTS[kind]))
        spans = F.when(hint & F.rlike(text, F.lit(PATTERNS[kind])), F.filter(matches(text, PATTERNS[kind]), _valid(kind)))
        typed = F.transform(spans, _typed(rank))
        parts.append(F.coalesce(typed, F.array().cast(SPANS)))
    return F.array_sort(F.concat(*parts))


def _entity(rank: Column, value: Column) -> Column:
    """Kind and normalised value of a protected entity."""
    return F.concat(rank.cast("string"), F.lit(":"), F.when(rank >= 2, _digits(value)).otherwise(F.lower(value)))


def _label(kind: str) -> str:
    return f"[{kind.upper()}]"


def _terms(text: Column) -> Column:
    """The distinct words of a text, lower case."""
    return F.array_distinct(F.transform(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: F.lower(w)))


def _outside(text: Column, spans: Column) -> Column:
    """The text with a letter for each span, so that words that touch one show."""
    return sp.replaced(text, spans, lambda s, pieces: F.lit(_HOLE))


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, spans, and near: for each span its entity and a hash of
    its surroundings."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("spans", base_spans(F.col("text")))
    # rows without spans get keys of their own, so that they don't gather
    key = F.when(F.size("spans") > 0, F.sha2("text", 256)).otherwise(F.concat(F.lit("-"), F.xxhash64("doc_id", "text").cast("string")))
    text, spans = F.col("text"), F.col("spans")
    empty = F.array().cast("array<struct<entity:string,context:bigint>>")
    near = F.when(F.size(spans) > 0, sp.let(sp.blocks(text), lambda pieces: F.transform(spans, lambda s: F.struct(
        _entity(s["rank"], s["value"]).alias("entity"),
        F.xxhash64(sp.cut(pieces, F.greatest(F.lit(0), s["start"] - REACH), s["start"]),
                   sp.cut(pieces, s["end"], s["end"] + REACH)).alias("context"))))).otherwise(empty)
    return rows.select("doc_id", key.alias("text_key"), "spans", near.alias("near"))


def _checked(keys: DataFrame) -> DataFrame:
    """Checkpointed ``keys``, broadcast if their bytes (with 64 a row for the table)
    are few enough; joined by a shuffle otherwise."""
    keys = keys.checkpoint()
    width = sum((F.octet_length(F.col(c).cast("string")) for c in keys.columns), F.lit(64))
    size = keys.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]
    return F.broadcast(keys) if size <= BROADCAST_BYTES else keys


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (text_key, ...) with the text of each key."""
    wanted = wanted.checkpoint()
    keyed = docs.select(F.sha2("text", 256).alias("text_key"), "text")
    return keyed.join(_checked(wanted.select("text_key")), "text_key", "left_semi").dropDuplicates(["text_key"]).join(wanted, "text_key")


def _term_counts(docs: DataFrame) -> tuple[DataFrame, int]:
    """(term, n_term) and their total, both of distinct texts: each of n copies of a
    text weighs 1/n."""
    key = F.xxhash64(F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit(""))))
    texts = docs.select(key.alias("copy_key")).groupBy("copy_key").agg(F.count("*").alias("copies")).checkpoint()
    copied = _checked(texts.where("copies > 1"))
    # outer: without, a filter on the array would make it twice; null terms fall out by length
    terms = (docs.select(key.alias("copy_key"), "text").join(copied, "copy_key", "left")
             .select("copies", F.explode_outer(_terms(F.col("text"))).alias("term")).where(F.length("term") >= 3)
             .groupBy("term").agg(F.round(F.sum(1 / F.coalesce("copies", F.lit(1)))).alias("n_term")))
    return terms, texts.count()


def disclosing_terms(docs: DataFrame, near: DataFrame, spans: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term) pairs where the term discloses the entity. ``near``:
    text_key, entity, context; ``spans``: text_key, spans, once a text."""
    held = near.groupBy("entity", "context").agg(F.min("text_key").alias("text_key")).select("entity", "text_key").distinct()
    entities = held.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support).checkpoint()
    wanted = held.join(entities, "entity").checkpoint()
    texts = wanted.groupBy("text_key").agg(F.max("n_entity").alias("most")).join(spans, "text_key")
    terms, total = _term_counts(docs)

    def most_texts(n_entity: Column) -> Column:  # of a term that may disclose an entity
        return total ** (1 - disclosure) * F.pow(n_entity, F.lit(disclosure)) * (1 + 1e-9)

    words = F.explode_outer(F.array(_terms(_outside(F.col("text"), F.col("spans")))))
    held_terms = (_texts(docs, texts).select("text_key", "most", words.alias("words"))
                  .select("text_key", "most", F.explode_outer("words").alias("term"))
                  .where((F.length("term") >= 3) & ~F.contains("term", F.lit(_HOLE))))
    able = (held_terms.join(terms.where(F.col("n_term") >= support), "term")
            .where(F.col("n_term") <= most_texts(F.col("most"))).select("text_key", "term", "n_term"))
    pairs = able.join(wanted, "text_key").where(F.col("n_term") <= most_texts(F.col("n_entity")))
    scored = (pairs.groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("both")).where(F.col("both") >= support)
              .withColumn("pmi", F.log2(F.col("both") * F.lit(total) / (F.col("n_entity") * F.col("n_term"))))
              .withColumn("ic", F.log2(F.lit(total) / F.col("n_entity"))))
    return scored.where((F.col("pmi") > 0) & (F.col("pmi") >= disclosure * F.col("ic"))).select("entity", "term")


def _places(text: Column, spans: Column, terms: Column) -> Column:
    """array<(start, rank, end, value)> of the words of a text that are among
    ``terms`` and touch none of ``spans``."""
    words = F.transform(matches(text, WORD), lambda w: F.struct(
        w["start"].alias("start"), F.lit(len(PATTERNS)).alias("rank"), w["end"].alias("end"), F.lower(w["value"]).alias("value")))
    return sp.let(sp.valued(words, terms), lambda found: sp.outside(found, spans))


def _term_spans(docs: DataFrame, marked: DataFrame, support: int, disclosure: float) -> DataFrame:
    """text_key, terms: array<(start, rank, end, value)> of the disclosing terms
    in the texts of their entities, once for each distinct text."""
    once = marked.where(F.size("near") > 0).dropDuplicates(["text_key"])
    near = once.select("text_key", F.explode("near").alias("x")).select("text_key", "x.*")
    spans = once.select("text_key", "spans")
    found = disclosing_terms(docs, near, spans, support, disclosure)
    wanted = near.select("text_key", "entity").distinct().join(found, "entity").groupBy("text_key").agg(F.collect_set("term").alias("wanted"))
    return _texts(docs, wanted.join(spans, "text_key")).select("text_key", _places(F.col("text"), F.col("spans"), F.col("wanted")).alias("terms"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_terms."""
    ensure_checkpoint_dir(docs.sparkSession)
    marked = _marked(docs).checkpoint()
    rows = marked.select("doc_id", "text_key", "spans").join(_term_spans(docs, marked, support, disclosure), "text_key", "left")
    terms = F.coalesce("terms", F.array().cast(SPANS))
    counts = [F.size(F.filter("spans", _of_rank(r))).cast("long").alias(f"n_{k}") for r, k in enumerate(PATTERNS)]
    return rows.select("doc_id", *counts, F.sha2(_listed(F.col("spans")), 256).alias("base_sha256"),
                       _listed(F.array_sort(F.concat("spans", terms))).alias("spans"), F.size(terms).cast("long").alias("n_terms"))


def _cleaned(text: Column, spans: Column) -> Column:
    """The text with each span replaced; of spans that overlap the first gives
    the label and all are covered."""
    labels = F.array(*(F.lit(_label(k)) for k in PATTERNS))

    def label(s: Column, pieces: Column) -> Column:
        original = sp.cut(pieces, s["start"], s["end"])
        general = F.when(F.rlike(original, F.lit("[0-9]")), F.lit("[NUMBER]")).when(F.rlike(original, F.lit(r"^\p{Lu}")), F.lit("[NAME]")).otherwise("")
        return F.coalesce(F.get(labels, s["rank"]), general)

    return sp.let(spans, lambda both: sp.replaced(text, both, label))


def sanitise(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """The rows of ``docs`` with its columns, spans replaced in ``text``. Texts
    without spans stay as they are and move nowhere."""
    ensure_checkpoint_dir(docs.sparkSession)
    marked = _marked(docs).where(F.size("spans") > 0).checkpoint()
    terms = _term_spans(docs, marked, support, disclosure)
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = F.col(names[docs.columns.index("text")])
    rows = docs.toDF(*names).withColumn("spans", base_spans(F.coalesce(text, F.lit(""))))
    with_spans = rows.where(F.size("spans") > 0).withColumn("text_key", F.sha2(text, 256)).join(terms, "text_key", "left")
    both = F.array_sort(F.concat("spans", F.coalesce("terms", F.array().cast(SPANS))))
    back = lambda frame, new: frame.select(*((new if c == "text" else F.col(n)).alias(c) for n, c in zip(names, docs.columns)))
    return back(with_spans, _cleaned(text, both)).union(back(rows.where(F.size("spans") == 0), text))
