"""Corpus pipeline: toxic documents go, exact copies go, of near duplicates one
stays, personal data is replaced, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each result as Parquet under the session's checkpoint
folder and reads it again, so a lost executor costs at most one stage's tasks."""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from trafficlens.llm import exact_dedup, near_dedup, packing, sanitise, toxicity
from trafficlens.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, rejects are left out."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each equal text stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_dedup.drop_near_copies(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced in the texts."""
    return sanitise.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as token sequences (one row per piece)."""
    return packing.pack(docs, tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("personal_data", replace_personal_data), ("packing", pack)]

#: The toxicity classifier can't be expressed in SQL; tests compare the stages
#: with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
