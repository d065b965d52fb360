"""Rows for the corner cases that every operator must take."""

import random
import re

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])

BLANK = re.compile("[\x20\x09-\x0d]+")


def odd_texts(seed=0, n=60):
    r = random.Random(seed)
    letters = "ab cdé  \n\t'sT'll ñß.,!?|<>0123中文́  \x1c\x85Σİ²ªº  @+-()"
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 80))) for _ in range(n)]


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(words))


def corner_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    long = prose(1, 9_000, 3000)
    rows = [(1, "one two three", "en", "s", 13), (1, "one two three", "en", "s", 13), (2, "one  two\nthree", None, None, None),
            (None, "one two three", "en", "s", 13), (None, "one two three", "en", "s", 13), (3, None, None, None, None),
            (4, "", "en", "s", 0), (5, " \n\t ", "en", "s", 4), (6, long, "en", "s", len(long)), (7, long + " end", "en", "s", 1),
            (8, "x" * 50_000, "en", "s", 50_000), (9, "<|endoftext|> a | b", "en", "s", 1), (None, None, None, None, None)]
    return rows + [(100 + i, t, "en", "s", len(t)) for i, t in enumerate(odd_texts())]


def frame(spark, rows, schema=SCHEMA, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts).cache()


def clashing(docs):
    """The same rows with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = ["sha", "keep", "salt", "body", "n", "node", "bin", "fill", "c0", "winner_id", "kept", "class_id", "score", "band",
             "key", "fp", "spans", "words", "term", "line", "template", "label", "features", "__row", "first", "ordinal", "toxic"]
    return docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names)))
