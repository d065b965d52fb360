"""Spans of a text (start, end exclusive, in code points) handled in time that
grows with the text: array columns, no Python.

``substring`` walks a text from its start and a fold that appends copies its
array, so a loop over many spans takes the square of their number. Here a text is
cut once into blocks of ``BLOCK`` code points, running maxima go by levels as the
running sums of ``secrets`` do, and sorted arrays are searched by halving.

An array that a lambda looks into must be a bound value (``let``), since the body
of a lambda is evaluated anew for each element."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .secrets import LEVEL
from .secrets import _let as let

_BITS = 8
BLOCK = 1 << _BITS
_PIECE = rf"(?s).{{1,{BLOCK}}}+"


def blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` code points, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end`` out of its blocks; empty where end <= start."""
    first, last = F.shiftright(start, _BITS), F.shiftright(end - 1, _BITS)
    joined = F.array_join(F.slice(pieces, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return F.when(end > start, F.substring(joined, start - first * BLOCK + 1, end - start)).otherwise("")


def running_max(values: Column, levels: int = 3) -> Column:
    """Running maxima of an array of ints of 0 and more (empty: empty)."""

    def plain(x: Column) -> Column:
        return F.aggregate(x, F.array().cast("array<int>"), lambda acc, v: F.concat(
            acc, F.array(F.greatest(F.get(acc, F.size(acc) - 1), v))))

    def joined(parts: Column) -> Column:
        tops = running_max(F.transform(parts, F.array_max), levels - 1)
        before = F.slice(F.concat(F.array(F.lit(0)), tops), 1, F.size(parts))
        return F.flatten(F.zip_with(F.transform(parts, plain), before, lambda x, b: F.transform(x, lambda v: F.greatest(v, b))))

    def parts(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(x), F.lit(LEVEL)), lambda at: F.slice(x, at, F.lit(LEVEL)))

    if levels == 1:
        return plain(values)
    return let(values, lambda x: F.when(F.size(x) > 0, let(parts(x), joined)).otherwise(F.array().cast("array<int>")))


def steps(values: Column) -> Column:
    """Powers of two, falling, that halve an array of this size."""
    return F.transform(F.sequence(F.length(F.bin(F.size(values))) - 1, F.lit(0), F.lit(-1)),
                       lambda i: F.call_function("shiftleft", F.lit(1), i))


def leading(values: Column, halves: Column, holds) -> Column:
    """How many values stand before the first one for which ``holds`` is false (it
    must be false from there on). ``halves``: ``steps(values)``."""
    return F.aggregate(halves, F.lit(0), lambda at, s: F.when(holds(F.get(values, at + s - 1)), at + s).otherwise(at))


def replaced(text: Column, spans: Column, label) -> Column:
    """The text with ``label(span, blocks)`` for each span of ``spans`` (sorted by
    start); of spans that overlap the first gives the label and all are covered."""

    def build(pieces: Column, reach: Column) -> Column:
        before = F.slice(F.concat(F.array(F.lit(0)), reach), 1, F.size(spans))
        parts = F.zip_with(spans, before, lambda s, at: F.when(
            s["start"] >= at, F.concat(cut(pieces, at, s["start"]), label(s, pieces))).otherwise(""))
        return F.concat(F.array_join(parts, ""), cut(pieces, F.get(reach, F.size(reach) - 1), F.length(text)))

    ends = F.transform(spans, lambda s: s["end"])
    return F.when(F.size(spans) > 0, let(blocks(text), lambda p: let(running_max(ends), lambda r: build(p, r)))).otherwise(text)


def outside(spans: Column, others: Column) -> Column:
    """The spans that overlap none of ``others`` (sorted by start)."""
    starts, ends = F.transform(others, lambda s: s["start"]), F.transform(others, lambda s: s["end"])

    def free(starts: Column, halves: Column, reach: Column) -> Column:
        return F.filter(spans, lambda w: F.coalesce(
            F.get(reach, leading(starts, halves, lambda x: x < w["end"]) - 1) <= w["start"], F.lit(True)))

    return let(starts, lambda a: let(steps(a), lambda h: let(running_max(ends), lambda r: free(a, h, r))))


def valued(spans: Column, values: Column) -> Column:
    """The spans whose ``value`` is among ``values``."""

    def found(known: Column, halves: Column) -> Column:
        return F.filter(spans, lambda w: F.coalesce(
            F.get(known, leading(known, halves, lambda x: x <= w["value"]) - 1) == w["value"], F.lit(False)))

    return let(F.array_sort(values), lambda v: let(steps(v), lambda h: found(v, h)))
