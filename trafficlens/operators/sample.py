"""Per-capture prefix sample and per-capture totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import position_in_group


def with_capture_positions(frames: DataFrame, capture: str = "path", order: list[str] | None = None,
                           out: str = "ordinal", total: str = "n_in_capture") -> DataFrame:
    """Add the 0-based position of each record in its capture and the
    capture's record count, without a per-capture window (skew-safe)."""
    return position_in_group(frames, [capture], order or ["ts", "event_id"], out=out, total=total)


def prefix_sample(frames: DataFrame, percent: int, ordinal: str = "ordinal",
                  total: str = "n_in_capture", compat: bool = False) -> DataFrame:
    """Keep the first ``floor(percent · n / 100)`` records of every capture.
    ``compat=True`` keeps one more, as the original extraction loop did
    (it broke only after passing the limit)."""
    limit = F.expr(f"({total} * {int(percent)}) div 100")
    cond = F.col(ordinal) <= limit if compat else F.col(ordinal) < limit
    return frames.where(cond)


def packets_per_capture(frames: DataFrame, capture: str = "path") -> DataFrame:
    """Total records per capture (partial aggregation, skew-safe)."""
    return frames.groupBy(capture).agg(F.count(F.lit(1)).alias("packets"))
