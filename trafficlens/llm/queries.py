"""Registered queries of this package and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (byte_bpe, exact_dedup, hard_negatives, licenses, near_dedup, packing, repetition, sanitise, secrets, templates,
               token_counts, toxicity, whitening)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str):
    def keep(fn):
        REGISTRY[name] = fn
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op1_suffix_repetition")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


@register("op4_exact_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


SQL["op4_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)"""


@register("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"),
                                       tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)


@register("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizers.path("word_bpe_49k.json"))


@register("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizers.path("word_bpe_49k.json"))


@register("op2_weighted_minhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_classes(table(spark, sf_dir, "documents"))


@register("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op5_sanitise")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.personal_data(table(spark, sf_dir, "documents"))


@register("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(table(spark, sf_dir, "documents"))


@register("op8_template_lines")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.template_report(table(spark, sf_dir, "documents"))


@register("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register("op12_hard_negatives")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


SQL["op12_hard_negatives"] = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q,
    (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_inner_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.r <> b.r
  WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT anchor, anchor_id, id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST) AS which
  FROM scored WHERE same
  QUALIFY which <= 5
)
SELECT p.anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
    (row_number() OVER (PARTITION BY p.anchor, p.which ORDER BY s.score DESC, s.id NULLS LAST))::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
) p
WHERE rank <= 3"""


@register("op13_secret_links")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))
