"""Row preparation before training: canonical projection, label cast, null
policy, class subsets, min-max scaling and the reproducible key-hash split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FEATURE_COLUMNS, PACKET_COLUMNS

NULL_POLICIES = ("error", "skip", "zero", "keep")


def canonical(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 20 packet columns in canonical order (plus ``keep``)."""
    return df.select(*(keep or []), *PACKET_COLUMNS)


def label_as_double(df: DataFrame, label: str = "CLASS") -> DataFrame:
    return df.withColumn(label, F.col(label).cast("double"))


def class_subset(df: DataFrame, classes: list[str], name_col: str = "class_name") -> DataFrame:
    """Keep the named classes; on a table partitioned by class this is
    partition pruning, otherwise a pushed-down IN filter."""
    return df.where(F.col(name_col).isin(*classes))


def apply_null_policy(df: DataFrame, policy: str = "skip",
                      features: list[str] | None = None) -> DataFrame:
    """``error``: leave nulls (the assembler then fails on them, as the
    original pipeline would); ``skip``: drop rows with any null feature;
    ``zero``: fill nulls with 0; ``keep``: leave nulls for an assembler with
    ``handleInvalid='keep'`` (NaN)."""
    feats = features or FEATURE_COLUMNS
    if policy not in NULL_POLICIES:
        raise ValueError(f"null policy {policy!r} not in {NULL_POLICIES}")
    if policy == "skip":
        return df.na.drop(subset=feats)
    if policy == "zero":
        return df.na.fill(0, subset=feats)
    return df


def null_counts(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """One row per feature: ``(feature, nulls, rows)`` in one pass."""
    feats = features or FEATURE_COLUMNS
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in feats])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("bigint").alias("nulls")) for c in feats])
    return agg.select(F.inline(pairs), F.col("_rows").alias("rows"))


def minmax_summary(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """One row per feature: ``(feature, min, max)`` in one pass."""
    feats = features or FEATURE_COLUMNS
    agg = df.agg(*[F.min(F.col(c).cast("double")).alias("mn_" + c) for c in feats],
                 *[F.max(F.col(c).cast("double")).alias("mx_" + c) for c in feats])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col("mn_" + c).alias("min"),
                               F.col("mx_" + c).alias("max")) for c in feats])
    return agg.select(F.inline(pairs))


def minmax_scale(df: DataFrame, features: list[str] | None = None, fit_on: DataFrame | None = None,
                 suffix: str = "") -> DataFrame:
    """Scale each feature to [0, 1] with min/max from ``fit_on`` (default
    ``df``); a constant feature maps to 0.5, as Spark ML's MinMaxScaler does.
    The summary is one aggregate row (2 numbers per feature)."""
    feats = features or FEATURE_COLUMNS
    src = fit_on if fit_on is not None else df
    row = src.agg(*[F.min(F.col(c).cast("double")).alias("mn_" + c) for c in feats],
                  *[F.max(F.col(c).cast("double")).alias("mx_" + c) for c in feats]).first()
    out = df
    for c in feats:
        mn, mx = row["mn_" + c], row["mx_" + c]
        x = F.col(c).cast("double")
        if mn is None or mx is None:
            scaled = F.lit(None).cast("double")
        elif mx == mn:
            scaled = F.when(x.isNotNull(), F.lit(0.5))
        else:
            scaled = (x - F.lit(mn)) / F.lit(mx - mn)
        out = out.withColumn(c + suffix, scaled)
    return out


def split_key(*cols: str) -> Column:
    return F.concat_ws(":", *[F.col(c).cast("string") for c in cols])


def split_bucket(key: Column, seed: int = 42) -> Column:
    """0..99 from md5 of ``seed:key`` — a pure function of the row key, so the
    split is the same for any partitioning, executor count or rerun."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), key))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def hash_split(df: DataFrame, key_cols: list[str], train_percent: int = 80,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    b = split_bucket(split_key(*key_cols), seed)
    return df.where(b < train_percent), df.where(b >= train_percent)


def with_split_flag(df: DataFrame, key_cols: list[str], train_percent: int = 80,
                    seed: int = 42, out: str = "is_train") -> DataFrame:
    return df.withColumn(out, split_bucket(split_key(*key_cols), seed) < train_percent)


def random_split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42):
    """Compatibility mode: ``randomSplit`` (depends on partitioning)."""
    return df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
