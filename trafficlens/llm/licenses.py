"""License scan: MinHash bands over overlapping windows, then exact containment.

A text is its words (runs of letters and digits, lower case). Every ``STRIDE``
words a window of ``WINDOW`` words starts; its shingles are its word pairs. A
window has ``BANDS`` band keys, each of ``ROWS`` minima of the shingle hashes
under different permutations (exclusive or with a constant). Templates have
windows at every word, so a passage that repeats a template meets a template
window of the same words at once and shares all keys: retrieval is certain for
templates of ``WINDOW + STRIDE - 1`` unchanged words or more, and has chance
1 - (1 - J^ROWS)^BANDS per window of similarity J beyond that.

Templates of fewer than ``WINDOW + STRIDE - 1`` words are matched as they are:
all their words, one after the other.

A hit at template offset o says where the template would start. There the
template's word pairs are matched exactly: containment is the share of them that
the stretch of the template's length, and a quarter more at both sides, holds.
At ``CONTAINMENT`` or more it is a match.

Only DataFrame functions. The template list is a short fixed parameter, so its
keys are literals and its table is broadcast. A match lacks at most a fifth of a
template's pairs, so it holds one of the template's ``anchor_words``; texts with
none of any template's leave at the scan, before any window is made, and texts
without a common band key right after. Nothing but hits is shuffled.

Result: one row per (doc_id, text, template): the first best place (where the
first of the template's pairs stands), its
containment and the number of places. Rows that repeat id and text count once,
null texts have no match, null ids stay null, extra columns are ignored, texts
of any length are scanned whole; empty in, empty out."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, STRIDE = 4, 2
BANDS, ROWS = 4, 2
CONTAINMENT = 0.8

# Public license notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                      "that the following conditions are met",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense-line": "This is free and unencumbered software released into the public domain.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
                      "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "bsd-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                      "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                      "PARTICULAR PURPOSE ARE DISCLAIMED.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
                    "for more details.",
    "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                   "General Public License as published by the Free Software Foundation",
}
_CONSTANTS = [int.from_bytes(bytes((37 * k + 101 * i + 11 * k * i + 59) % 256 for i in range(8)), "little", signed=True)
              for k in range(1, BANDS * ROWS + 1)]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _pairs() -> Column:
    """Hash of each two neighbouring words of the column ``words`` (a column, as
    an expression would be evaluated anew for each place)."""
    words = F.col("words")
    return F.when(F.size(words) >= 2, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1))))


def _window_keys(stride: int) -> Column:
    """Band keys of each window of the column ``pairs``, in order: array<array<long>>."""
    pairs = F.col("pairs")
    last = F.size(pairs) - (WINDOW - 1)

    def keys(i):
        held = [F.get(pairs, i + j) for j in range(WINDOW - 1)]
        least = [F.least(*(h.bitwiseXOR(F.lit(c)) for h in held)) for c in _CONSTANTS]
        return F.array(*(F.xxhash64(F.lit(b), *least[b * ROWS:(b + 1) * ROWS]) for b in range(BANDS)))

    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last, F.lit(stride)), keys))


def _template_table(spark, templates: dict[str, str]) -> DataFrame:
    """template, n (words), pairs (distinct), offset, keys."""
    t = spark.createDataFrame(sorted(templates.items()), "template string, text string").withColumn("words", _words(F.col("text")))
    t = t.withColumn("pairs", _pairs())
    return t.select("template", F.size("words").alias("n"), F.array_distinct("pairs").alias("asked"),
                    F.posexplode(_window_keys(1)).alias("offset", "keys"))


def anchor_words(templates: dict[str, str], containment: float) -> list[str]:
    """Words of which each match holds one: in every template the longest words,
    until they touch more word pairs than a match may lack."""
    out = set()
    for text in templates.values():
        words = re.findall(r"[^\W_]+", text.lower())
        pairs = set(zip(words, words[1:]))
        allowed, touched = len(pairs) - math.ceil(containment * len(pairs) - 1e-9), set()
        for word in sorted(set(words), key=lambda w: (-len(w), w)):
            if len(touched) > allowed:
                break
            out.add(word)
            touched |= {p for p in pairs if word in p}
    return sorted(out)


def _plain_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _at(asked: list[str]):
    """The index of a word of ``words`` where ``asked`` starts, null elsewhere."""
    def start(word, i):
        here = word == asked[0]
        for j in range(1, len(asked)):
            here = here & (F.get("words", i + j) == asked[j])
        return F.when(here, i)
    return start


def _short_matches(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """Matches of templates that are too short for windows: their words in a row."""
    likely, found = F.lit(False), []
    for name, text in sorted(templates.items()):
        asked = _plain_words(text)
        if not asked:
            raise ValueError(f"template {name} has no word")
        likely = likely | F.contains("lower", F.lit(max(asked, key=len)))
        found.append(F.struct(F.lit(name).alias("template"), F.filter(F.transform("words", _at(asked)), lambda i: i.isNotNull()).alias("starts")))
    once = lambda c: F.explode(F.array(c))
    rows = (docs.select("doc_id", "text", once(F.lower("text")).alias("lower")).where(likely)
            .select("doc_id", F.sha2("text", 256).alias("text_key"), once(_words(F.col("text"))).alias("words"))
            .select("doc_id", "text_key", F.explode(F.array(*found)).alias("m")).where(F.size("m.starts") > 0)
            .select("doc_id", "text_key", "m.template", F.get("m.starts", F.lit(0)).cast("long").alias("start_word"),
                    F.size("m.starts").cast("long").alias("places")))
    return (rows.dropDuplicates(["doc_id", "text_key", "template"])
            .select("doc_id", "template", "start_word", F.lit(1.0).alias("containment"), "places"))


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, template, start_word, containment, places."""
    templates = TEMPLATES if templates is None else templates
    short = {k: v for k, v in templates.items() if len(_plain_words(v)) < WINDOW + STRIDE - 1}
    long = {k: v for k, v in templates.items() if k not in short}
    if not long:
        return _short_matches(docs, short)
    found = _window_matches(docs, long, containment)
    return found.union(_short_matches(docs, short)) if short else found


def _window_matches(docs: DataFrame, templates: dict[str, str], containment: float) -> DataFrame:
    table = _template_table(docs.sparkSession, templates)
    known = table.select(F.explode("keys").alias("key")).distinct()
    literal = F.array(*(F.lit(r.key) for r in known.collect()))  # as many as the templates have windows and bands
    # exploding an array of one keeps the optimizer from folding each step into
    # the next, where it would be evaluated anew for every place
    once = lambda c: F.explode(F.array(c))
    anchored = F.lit(False)
    for word in anchor_words(templates, containment):
        anchored = anchored | F.contains("lower", F.lit(word))
    worded = docs.select("doc_id", "text", once(F.lower("text")).alias("lower")).where(anchored).select("doc_id", "text", once(_words(F.col("text"))).alias("words"))
    keyed = worded.select("doc_id", "text", once(_pairs()).alias("pairs")).select("*", once(_window_keys(STRIDE)).alias("window_keys"))
    keyed = keyed.select("*", once(F.array_intersect(F.flatten("window_keys"), literal)).alias("known"))
    hits = (keyed.where(F.size("known") > 0)
            .select("doc_id", F.sha2("text", 256).alias("text_key"), "pairs",
                    F.filter(F.transform("window_keys", lambda k, i: F.struct(i.alias("window"), k.alias("keys"))),
                             lambda w: F.arrays_overlap(w["keys"], F.col("known"))).alias("windows")))
    starts = (hits.withColumn("w", F.explode("windows")).select("doc_id", "text_key", "pairs", (F.col("w.window") * STRIDE).alias("at"),
                                                                 F.explode("w.keys").alias("key"))
              .join(F.broadcast(table.select("template", "n", "asked", "offset", F.explode("keys").alias("key"))), "key"))
    slack = F.ceil(F.col("n") / 4).cast("int")
    low = F.greatest(F.lit(0), F.col("at") - F.col("offset") - slack)
    stretch = F.slice("pairs", low + 1, F.col("at") - F.col("offset") + F.col("n") - 1 + slack - low)
    found = (starts.withColumns({"low": low, "stretch": stretch})
             .withColumn("share", F.size(F.array_intersect("asked", "stretch")) / F.size("asked")).where(F.col("share") >= containment))
    place = F.array_min(F.filter(F.transform("asked", lambda p: F.array_position("stretch", p)), lambda at: at > 0))
    found = found.select("doc_id", "text_key", "template", (F.col("low") + place - 1).alias("start"), "share")
    best = F.min(F.struct((-F.col("share")).alias("less"), "start"))
    return (found.groupBy("doc_id", "text_key", "template").agg(best.alias("best"), F.count_distinct("start").alias("places"))
            .select("doc_id", "template", F.col("best.start").cast("long").alias("start_word"),
                    (-F.col("best.less")).alias("containment"), "places"))
