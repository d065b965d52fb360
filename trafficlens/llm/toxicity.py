"""Toxicity by gradient-boosted trees over dense features, isotonically calibrated.

Learning reads a bounded sample of the labelled rows (``SAMPLE``, by hash of the
id) whose crc32(id) mod 5 is not 0. Remainders 1 and 2 give the learned lexicon:
words and word beginnings whose share of toxic texts is far above their share of
the others, added to a short fixed list. Remainder 3 trains the trees,
remainder 4 fits the isotonic map from margin to probability, so no step judges
rows that the step before has learned from.

Features of a text: densities of strong, weak and fixed lexicon hits, their
number and highest weight, hits near a word of the second person, shares of
words in capitals and of mixed (obfuscated) words, hits after undoing digit and
symbol substitutions, rates of exclamation marks and other punctuation, length.
Labels, lang, source and ids are never features.

Null or empty text scores by its (zero) features. Rows with null label or id
don't teach; several labels of an id count as toxic if one is. Without labelled
rows of both classes in the folds every text scores the share of toxic rows (0
without any). Null and repeated ids and extra columns are fine; empty in, empty
out."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .arrow import slices, small_batches
from .chunktable import ChunkTable
from .slot import held
from .textbatch import Words, blocks, buffers

SAMPLE = 24_000
LEXICON_TERMS = 4000
LEAST_SUPPORT = 4
PREFIXES = (4, 5, 6)
NEAR_WORDS = 5
TREES, DEPTH = 20, 4

# Common insults, and second-person words of four languages.
INSULTS = ("idiot", "stupid", "moron", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "dumb",
           "fool", "jerk", "ugly", "hate", "shut", "freak", "creep", "liar", "coward")
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "euer",
                 "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros")
PLAIN = str.maketrans("013457@$!|", "oieastasii")

STRONG, WEAK, FIXED, PERSON, CAPITALS, MIXED, UNDONE = (1 << k for k in range(7))
FEATURES = ("strong", "weak", "fixed", "undone", "hits", "highest", "near_person", "capitals", "mixed", "exclaim", "punctuation",
            "length")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\W\d_][\d@$!|*#%&]+[^\W\d_]|^[\d@$!|]+[^\W\d_]{2}")


def terms(word: str) -> list[str]:
    """The lexicon entries that a bare lower-case word can match: itself and its
    beginnings (marked by a star)."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


def bare(word: str) -> str:
    return _EDGE.sub("", word.lower())


class Featurizer:
    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.fixed, self.person = set(INSULTS), set(SECOND_PERSON)
        self.table = ChunkTable(self._compute, 300_000)

    def _weight(self, word: str) -> float:
        return max((self.lexicon.get(t, 0.0) for t in terms(word)), default=0.0)

    def _compute(self, chunks: list[bytes]) -> list[bytes]:
        out = []
        for raw in chunks:
            text = raw.decode()
            word = bare(text)
            weight = self._weight(word)
            flags = (STRONG if weight >= 3 else WEAK if weight > 0 else 0) | (FIXED if word in self.fixed else 0)
            flags |= PERSON if word in self.person else 0
            flags |= CAPITALS if len(word) > 1 and text.upper() == text and text.lower() != text else 0
            if _INNER.search(text):
                flags |= MIXED
                plain = bare(text.lower().translate(PLAIN))
                if plain != word and (plain in self.fixed or self._weight(plain) >= 3):
                    flags |= UNDONE
            out.append((flags | (min(int(weight * 100), 4095) << 8)).to_bytes(4, "little"))
        return out

    def block(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, features)"""
        words = Words(data, offsets)
        first, _, values = self.table.lookup(data, words.start, words.end)
        v = values[first]
        n = np.maximum(words.counts, 1)

        def per_text(x):
            return np.diff(np.concatenate([[0], np.cumsum(x)])[words.first]).astype(float)

        count = {f: per_text((v & f) > 0) for f in (STRONG, WEAK, FIXED, CAPITALS, MIXED, UNDONE)}
        hit = (v & (STRONG | FIXED | UNDONE)) > 0
        persons = np.concatenate([[0], np.cumsum((v & PERSON) > 0)])
        doc = words.document()
        at = np.flatnonzero(hit)
        low = np.maximum(at - NEAR_WORDS, words.first[:-1][doc[at]])
        high = np.minimum(at + NEAR_WORDS + 1, words.first[1:][doc[at]])
        near = np.zeros(len(v))
        near[at] = persons[high] > persons[low]
        highest = np.zeros(len(n))
        np.maximum.at(highest, doc, (v >> 8) / 100)
        chars = np.maximum(words.word_chars(), 1)
        exclaim = words.count_in_documents((data == 33) | (data == 63))
        punctuation = words.count_in_documents((data > 32) & (data < 127) & ~_ALNUM[data])
        return np.stack([count[STRONG] / n, count[WEAK] / n, count[FIXED] / n, count[UNDONE] / n, per_text(hit), highest,
                         per_text(near), count[CAPITALS] / n, count[MIXED] / n, exclaim / chars, punctuation / chars,
                         np.log1p(words.counts)], axis=1)


_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[b for b in range(128) if chr(b).isalnum()]] = True
class _Lexicon:
    """A broadcast lexicon with a name of its own."""

    def __init__(self, spark, value: dict[str, float]):
        self.broadcast, self.id = spark.sparkContext.broadcast(value), ("lexicon", hash(tuple(sorted(value.items()))))

    @property
    def value(self):
        return self.broadcast.value


def with_features(docs: DataFrame, lexicon: _Lexicon) -> tuple[DataFrame, list[str]]:
    """The columns of ``docs`` under plain names, and ``features`` (array)."""
    small_batches(docs.sparkSession)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain, at = docs.toDF(*names), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = held(lexicon.id, lambda: Featurizer(lexicon.value))
        for batch in batches:
            data, offsets = buffers(batch.column(at))
            for a, b in blocks(offsets):
                x = f.block(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, lists], names=[*names, "features"])

    schema = T.StructType([*plain.schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))])
    return plain.mapInArrow(run, schema), names


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Terms of texts that mark toxic ones, with their log odds (at most
    ``LEXICON_TERMS``). ``rows``: text, label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for batch in slices(batches, 0):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {t for w in {bare(w) for w in (text or "").split()} if len(w) > 2 for t in terms(w)}
                seen[int(label > 0)].update(found)
        pos = [t for t, n in seen[1].items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(pos + list(seen[0].keys()), pa.string()), pa.array([seen[1][t] for t in pos] + [0] * len(seen[0]), pa.int64()),
             pa.array([0] * len(pos) + list(seen[0].values()), pa.int64())], names=["term", "pos", "neg"])

    totals = dict(rows.groupBy("label").count().collect())
    n_pos, n_neg = totals.get(1, 0), totals.get(0, 0)
    if not n_pos or not n_neg:
        return {}
    odds = F.log((F.col("pos") + 0.1) / n_pos) - F.log((F.col("neg") + 0.5) / n_neg)
    found = (rows.select("text", "label").mapInArrow(run, "term string, pos long, neg long").groupBy("term")
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") >= LEAST_SUPPORT)
             .withColumn("odds", odds).where("odds > 1.5 and pos > 3 * neg").orderBy(F.col("pos").desc(), "term").limit(LEXICON_TERMS))
    return {r.term: min(float(r.odds), 40.0) for r in found.collect()}


class ToxicityModel:
    """Lexicon, trees and calibration; ``score`` adds a probability to any rows."""

    def __init__(self, lexicon: _Lexicon, trees, isotonic, prior: float):
        self.lexicon, self.trees, self.isotonic, self.prior = lexicon, trees, isotonic, prior

    def score(self, docs: DataFrame) -> DataFrame:
        """The columns of ``docs`` (as c0, c1, ...) and ``p``."""
        rows, names = with_features(docs, self.lexicon)
        if self.trees is None:
            return rows.select(*names, F.lit(self.prior).alias("p"))
        margin = _margins(self.trees, rows.select(*names, array_to_vector("features").alias("features")))
        step = self.isotonic.transform(margin.select(*names, "margin"))
        # within a step of the isotonic map the margin still orders texts
        p = 0.99 * F.col("prediction") + 0.01 / (1 + F.exp(-2 * F.col("margin")))
        return step.select(*names, F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)).alias("p"))


def _margins(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("margin", vector_to_array("rawPrediction")[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Learn from the labelled rows of ``docs`` (doc_id, text) whose crc32(id) mod
    5 is not 0; ``labels``: doc_id, toxic."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id")
             .agg(F.max(F.col("toxic").cast("int")).alias("label")).withColumn("fold", fold).where("fold != 0")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))  # bounded, so broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "label", "fold").checkpoint()
    shares = dict(rows.groupBy("label").count().collect())
    prior = float(shares.get(1, 0) / max(1, sum(shares.values())))
    lexicon = _Lexicon(spark, learn_lexicon(rows.where("fold in (1, 2)")))
    featured, names = with_features(rows.select("text", "label", "fold").where("fold in (3, 4)"), lexicon)
    featured = featured.select(F.col(names[1]).cast("double").alias("label"), F.col(names[2]).alias("fold"),
                               array_to_vector("features").alias("features")).repartition(4).checkpoint()
    counts = {(r.fold, r.label): r["count"] for r in featured.groupBy("fold", "label").count().collect()}
    if any(counts.get((f, y), 0) == 0 for f in (3, 4) for y in (0.0, 1.0)):
        return ToxicityModel(lexicon, None, None, prior)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1, cacheNodeIds=False).fit(featured.where("fold = 3"))
    calibration = _margins(trees, featured.where("fold = 4")).select("margin", "label")
    isotonic = IsotonicRegression(featuresCol="margin", labelCol="label").fit(calibration)
    return ToxicityModel(lexicon, trees, isotonic, prior)


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    scored = fit(docs, labels, sample).score(docs.select("doc_id", "text"))
    return scored.select(F.col("c0").alias("doc_id"),
                         (F.crc32(F.col("c0").cast("string")) % 5 == 0).alias("held_out"),
                         F.col("p").alias("score"), (F.col("p") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with its columns."""
    scored = fit(docs, labels, sample).score(docs)
    return scored.where(F.col("p") < threshold).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
