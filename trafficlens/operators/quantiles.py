"""Exact quantiles of columns with any number of distinct values.

Two passes over the data and no task that holds a feature:

1. per feature, one mergeable sketch (``percentile_approx``) gives a bracket
   [low, high] around every wanted rank. The sketch errs by at most n / accuracy
   ranks and the bracket spans ``WIDTH`` times that to either side, so the rank
   lies inside; up to ``accuracy`` rows the bracket is the whole column;
2. bracket ends cut the axis into zones. Values in a bracket are counted one by
   one, all others by zone only, in one partial aggregate: a small, bounded share
   of the data (2 * (WIDTH + 1) / accuracy per rank) is shuffled.

The counts, ordered by zone and value, get running totals over range tasks
(``ordered.running_total``); the value whose total first passes a rank has it.
A rank outside its bracket would be an error, never a wrong value. Only the
bracket table (one row per feature) is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running_total

ACCURACY = 10000
WIDTH = 3


def _brackets(long: DataFrame, probabilities: list[float], accuracy: int) -> DataFrame:
    """(feature, n, min, max, low, high): arrays with an entry per probability."""
    v, slack = F.col("value"), WIDTH / accuracy

    def sketch(shift: float) -> Column:
        return F.percentile_approx(v, F.array(*(F.lit(min(max(p + shift, 0.0), 1.0)) for p in probabilities)), accuracy)

    rows = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
                                       sketch(-slack).alias("low"), sketch(slack).alias("high"))
    few = F.col("n") <= accuracy
    ends = [F.array(*(F.when(few | F.lit(out(p)), F.col(end)).otherwise(F.col(side)[i]) for i, p in enumerate(probabilities))).alias(side)
            for side, end, out in (("low", "min", lambda p: p <= slack), ("high", "max", lambda p: p >= 1 - slack))]
    return rows.select("feature", "n", "min", "max", *ends)


def _zone_counts(long: DataFrame, brackets: DataFrame, ranks: int) -> DataFrame:
    """(feature, zone, value, n): ``value`` only inside a bracket. An odd zone is one
    bracket end, an even zone lies between two."""
    v = F.col("value")
    rows = long.join(F.broadcast(brackets.select("feature", "low", "high", F.array_sort(F.concat("low", "high")).alias("ends"))), "feature")
    below, at, inside = F.lit(0), F.lit(False), F.lit(False)
    for i in range(2 * ranks):
        below = below + (v > F.col("ends")[i]).cast("int")
        at = at | (v == F.col("ends")[i])
    for i in range(ranks):
        inside = inside | v.between(F.col("low")[i], F.col("high")[i])
    return (rows.select("feature", (2 * below + at.cast("int")).alias("zone"), F.when(inside, v).alias("value"))
            .groupBy("feature", "zone", "value").agg(F.count(F.lit(1)).alias("n")))


def exact_quantiles(long: DataFrame, probabilities: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """``(feature, n, min, max, q)`` of ``long`` (feature, value DOUBLE, no nulls): ``q``
    holds one value per probability, interpolated between the closest ranks as
    ``percentile`` does. NaN counts as larger than any number. A feature without
    values has no row; an empty input gives an empty result."""
    brackets = _brackets(long, probabilities, accuracy).checkpoint()
    totals = running_total(_zone_counts(long, brackets, len(probabilities)), ["feature"], ["zone", "value"], "n")
    position = [(F.col("total") - 1) * p for p in probabilities]
    wanted = [(f"{side}{i}", rank(pos)) for i, pos in enumerate(position) for side, rank in (("lo", F.floor), ("hi", F.ceil))]
    rows = totals.join(F.broadcast(brackets.select("feature", F.col("n").alias("total"))), "feature")
    holds = {name: (F.col("cum") - F.col("n") <= rank) & (rank < F.col("cum")) for name, rank in wanted}
    found = rows.groupBy("feature").agg(*(F.max(F.when(hold, F.col("value"))).alias(name) for name, hold in holds.items()))
    value = []
    for i, p in enumerate(probabilities):
        lo, hi, pos = F.col(f"lo{i}"), F.col(f"hi{i}"), (F.col("n") - 1) * p
        mixed = F.when(F.ceil(pos) == F.floor(pos), lo).otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi)
        value.append(F.when(lo.isNull() | hi.isNull(), F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")).otherwise(mixed))
    return brackets.join(found, "feature").select("feature", "n", "min", "max", F.array(*value).alias("q"))
