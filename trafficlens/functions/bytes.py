"""Unsigned big-endian integers read out of a BINARY column.

All helpers build Column expressions (JVM side, whole-stage codegen); no
Python runs per row. Positions are 1-based, like ``substring``; a position may
itself be a Column (e.g. the start of layer 4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def uint(frame: Column, pos, length: int) -> Column:
    """Unsigned integer of ``length`` bytes at ``pos``. ``pos`` appears once
    in the expression (no nested copies); callers guard truncation at the
    layer level (a layer is present only if its sub-frame is long enough)."""
    return F.conv(F.hex(F.substring(frame, _lit(pos), F.lit(length))), 16, 10).cast("bigint")


def uint8(frame: Column, pos) -> Column:
    return uint(frame, pos, 1).cast("int")


def uint16(frame: Column, pos) -> Column:
    return uint(frame, pos, 2).cast("int")


def uint32(frame: Column, pos) -> Column:
    return uint(frame, pos, 4)
