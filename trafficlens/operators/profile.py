"""Data-set profile (rows, columns, classes) and box statistics.

Everything is one aggregate job with partial (map-side) aggregation; nothing
is collected to the driver except the final one-row or one-row-per-feature
results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import staged
from .quantiles import exact_quantiles

QUARTILES = [0.25, 0.5, 0.75]


def profile(df: DataFrame, label: str = "CLASS") -> DataFrame:
    """One row: ``rows``, ``columns``, ``classes`` (distinct non-null labels)
    — the three profile numbers in a single pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.count_distinct(F.col(label)).alias("classes"),
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def stack_features(df: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """Long form ``(feature, value DOUBLE)``, nulls dropped; one generator
    over the scan, so all features are profiled in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                      for c in features])
    return (df.select(*(keep or []), F.inline(pairs))
            .where(F.col("value").isNotNull()))


def _quartiles(value: Column, accuracy: int) -> Column:
    return F.percentile_approx(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy)


def value_histogram(df: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, value, n)``: one partial-aggregated pass over the data.
    Its size is bounded by the distinct values per feature (at most 65 536
    for the 8/16-bit header fields), not by the row count."""
    return stack_features(df, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def _stats_from_histogram(hist: DataFrame) -> DataFrame:
    """Exact quartiles (linear interpolation between closest ranks, as
    ``percentile`` does), fences, whiskers and flier counts per feature,
    computed on the histogram alone."""
    w = Window.partitionBy("feature")
    run = w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    h = (hist.withColumn("cum", F.sum("n").over(run))
         .withColumn("total", F.sum("n").over(w))
         .withColumn("first_rank", F.col("cum") - F.col("n")))
    aggs = [F.first("total").alias("n"), F.min("value").alias("min"), F.max("value").alias("max")]
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        pos = (F.col("total") - 1) * p
        for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            covers = (F.col("first_rank") <= rank) & (rank < F.col("cum"))
            aggs.append(F.min(F.when(covers, F.col("value"))).alias(f"_{name}_{side}"))
        aggs.append(F.first(pos).alias(f"_{name}_pos"))
    st = h.groupBy("feature").agg(*aggs)
    for name in ("q1", "median", "q3"):
        pos, lo, hi = F.col(f"_{name}_pos"), F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        st = st.withColumn(name, F.when(F.ceil(pos) == F.floor(pos), lo)
                           .otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi))
    st = st.drop(*[c for c in st.columns if c.startswith("_")])
    return st.withColumn("iqr", F.col("q3") - F.col("q1")) \
             .withColumn("lo_fence", F.col("q1") - F.col("iqr") * 1.5) \
             .withColumn("hi_fence", F.col("q3") + F.col("iqr") * 1.5)


def _fences(q: DataFrame) -> DataFrame:
    """(feature, n, min, max, q) with quartiles and fences by name."""
    q = q.select("feature", "n", "min", "max",
                 F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    return q.withColumn("iqr", F.col("q3") - F.col("q1")) \
            .withColumn("lo_fence", F.col("q1") - F.col("iqr") * 1.5) \
            .withColumn("hi_fence", F.col("q3") + F.col("iqr") * 1.5)


def _quartile_table(long: DataFrame, exact: bool, accuracy: int) -> DataFrame:
    """Quartiles and fences of unbounded columns, exact by brackets or approximate."""
    if exact:
        return _fences(exact_quantiles(long, QUARTILES, accuracy))
    return _fences(long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("min"), F.max("value").alias("max"),
        _quartiles(F.col("value"), accuracy).alias("q")))


def box_statistics(df: DataFrame, features: list[str], exact: bool = True,
                   accuracy: int = 10000, bounded: bool = True) -> DataFrame:
    """Per feature: n, min, q1, median, q3, iqr, whiskers (most extreme data
    inside 1.5·IQR of the box) and flier count.

    For ``bounded`` features (few distinct values, as header fields) ``exact``
    reads the data once into a value histogram and derives everything from it.
    With ``bounded=False`` any number of distinct values is exact too: sketch
    brackets, a count inside them (``quantiles.py``) and a pass for the whiskers.
    ``exact=False`` uses ``percentile_approx`` instead of the brackets."""
    out_cols = ["feature", "n", "min", "q1", "median", "q3", "max", "iqr", "whisker_lo", "whisker_hi", "fliers"]
    v, lo, hi = F.col("value"), F.col("lo_fence"), F.col("hi_fence")
    if exact and bounded:
        hist = value_histogram(df, features)
        st = _stats_from_histogram(hist)
        # the joined side is the per-feature summary (one row per feature)
        wk = hist.join(F.broadcast(st.select("feature", "lo_fence", "hi_fence")), "feature") \
            .groupBy("feature").agg(
                F.min(F.when(v >= lo, v)).alias("whisker_lo"),
                F.max(F.when(v <= hi, v)).alias("whisker_hi"),
                F.sum(F.when((v < lo) | (v > hi), F.col("n")).otherwise(F.lit(0))).alias("fliers"))
        return st.join(wk, "feature").select(*out_cols)
    long = stack_features(staged(df.select(*[F.col(c).cast("double").alias(c) for c in features]), "columns"), features)
    q = _quartile_table(long, exact, accuracy)
    # one row per feature: broadcast is bounded by the feature count.
    # Values below the lower whisker are exactly those below the lower fence
    # (and likewise above), so whiskers and flier counts share one pass.
    fences = F.broadcast(q.select("feature", "lo_fence", "hi_fence"))
    w = long.join(fences, "feature").groupBy("feature").agg(
        F.min(F.when(v >= lo, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi, v)).alias("whisker_hi"),
        F.count_if((v < lo) | (v > hi)).alias("fliers"),
    )
    return q.join(w, "feature").select(*out_cols)


def box_fliers(df: DataFrame, features: list[str], exact: bool = True, accuracy: int = 10000, bounded: bool = True) -> DataFrame:
    """Every value drawn as a flier: ``(feature, value, n)`` — distinct flier
    values with their multiplicity (no cap). Parameters as in ``box_statistics``."""
    v = F.col("value")
    if exact and bounded:
        hist = value_histogram(df, features)
        st = _stats_from_histogram(hist)
        return (hist.join(F.broadcast(st.select("feature", "lo_fence", "hi_fence")), "feature")
                .where((v < F.col("lo_fence")) | (v > F.col("hi_fence")))
                .select("feature", "value", "n"))
    long = stack_features(staged(df.select(*[F.col(c).cast("double").alias(c) for c in features]), "columns"), features)
    q = _quartile_table(long, exact, accuracy).select("feature", "lo_fence", "hi_fence")
    return (long.join(F.broadcast(q), "feature")
            .where((v < F.col("lo_fence")) | (v > F.col("hi_fence")))
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
