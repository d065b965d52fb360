"""Secrets: base spans by pattern, and weak credentials told by their company.

Base kinds (leftmost, not overlapping, per kind; matches that fail their check
are dropped, without retries): assign (value of 8 characters or more), access (16
or more) and hex (32 or more).

Weak parts prove nothing alone:

* login: a name given to a user, login, account, client id or access key id;
* weak: a value given to a pass word, key, credential or the like under names that
  the base kinds don't know, or too short for them (4 to 7 characters); or a run of
  20 characters or more of letters of either case and digits;
* endpoint: a URL of a service, or a value given to a host, server or endpoint.

Linking: a text's scopes are its blocks of lines between blank lines. Parts are
intervals; identifiers (login and the base kind access), secrets (weak and the base
kinds assign and hex) and endpoints are joined by interval: same scope, not
overlapping, at most ``REACH`` code points between them. A weak secret is reported
where an identifier or an endpoint is joined to it, a login or an endpoint where a
secret is. Weak parts that overlap a base span, and run secrets inside an endpoint,
are left out. Base spans always stay.

Interval joins use tiles of ``REACH`` code points: an interval widened by the reach
is listed under each tile that it covers, its partner under each tile that it
touches, so the equality join on (text, scope, tile) finds all pairs. Matches of a
kind don't overlap and are three characters or more, so a tile holds a bounded
number of parts: no key grows with the corpus, and pairs grow with the length of
the texts. Only texts that hold complementary parts enter the join. Positions come
from running sums by levels of ``LEVEL`` (no list is rebuilt per match).

Only DataFrame functions. Positions are code points, ends exclusive. Null text
counts as empty: no spans. Rows may repeat ids or have none: spans depend on the
text alone. The parts (no texts) are written to the shared checkpoint folder
with a row number, so rows are told apart however ids repeat. Extra columns are
ignored. Empty in, empty out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

REACH = 400
LEVEL = 64
KINDS = ("assign", "access", "hex", "login", "weak", "endpoint")
PART = "array<struct<start:int,end:int,value:string>>"

# The base patterns. Those of access and hex hold the least length,
# which changes no match: a run is tried from its first character on, and if it is
# too short, so is every rest of it.
BASE = {
    "assign": r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++""",
    "access": r"AKIA[A-Z0-9]{12,}+",
    "hex": r"[0-9a-f]{32,}+",
}
_VALUE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
LEAST_VALUE = 8
_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
LOGIN = r"(?<![A-Za-z])(?i:user(?:_?name|_?id)?|login|account(?:_?name|_?id)?|client_?id|access_?key(?:_?id)?)" + _GIVEN + r"[A-Za-z0-9_.@+-]{3,}+"
NAMED = (r"(?<![A-Za-z])(?i:pass(?:phrase|code)?|pwd|pin|credentials?|auth(?:orization)?|(?:private|encryption|access|account)_?key)"
         + _GIVEN + r"""[^\s"',;<>]{4,}+""")
SHORT = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{4,7}+(?![A-Za-z0-9+/_.=-])"""
RUN = r"(?<![A-Za-z0-9+/_=-])(?=[a-z0-9+/_=-]*+[A-Z])(?=[A-Z0-9+/_=-]*+[a-z])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"
ENDPOINT = (r"(?<![A-Za-z])(?:(?i:https?|ftps?|sftp|ssh|wss?|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|rediss?|amqps?)://"
            r"""[^\s"'<>]{3,}+|(?i:host(?:name)?|server|endpoint)""" + _GIVEN + r"[A-Za-z0-9-]++(?:[.:][A-Za-z0-9-]++)++)")
WEAK = {"login": LOGIN, "weak": f"(?:{NAMED}|{SHORT}|{RUN})", "endpoint": ENDPOINT}
BLANK_LINE = r"\n[\x20\t\r\x0b\f]*+(?=\n)"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (a lambda's body is evaluated
    anew for each element, with all that stands in it)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, levels: int = 3) -> Column:
    """Running sums of an int array (each with its own value): blocks of ``LEVEL``
    are summed by themselves, and the sums of the blocks by the level above."""

    def plain(x: Column) -> Column:
        return F.aggregate(x, F.array().cast("array<int>"), lambda acc, v: F.concat(
            acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + v)))

    def joined(cut: Column) -> Column:
        ends = _running(F.transform(cut, _sum), levels - 1)
        return F.flatten(F.zip_with(F.transform(cut, plain), ends, lambda x, end: _let(
            end - F.element_at(x, -1), lambda before: F.transform(x, lambda v: v + before))))

    def blocks(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(x), F.lit(LEVEL)), lambda at: F.slice(x, at, F.lit(LEVEL)))

    if levels == 1:
        return plain(values)
    return _let(values, lambda x: F.when(F.size(x) > 0, _let(blocks(x), joined)).otherwise(F.array().cast("array<int>")))


def matches(text: Column, pattern: str) -> Column:
    """(start, end, value) of every match, in order: running sums over the lengths
    of the pieces between the matches and of the matches."""

    def spans(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        steps = F.zip_with(gaps, found, lambda g, m: F.length(g) + F.length(m))
        return F.zip_with(_running(steps), found, lambda end, m: F.struct(
            (end - F.length(m)).alias("start"), end.alias("end"), m.alias("value")))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.rlike(text, F.lit(pattern)), _let(found, spans)).otherwise(F.array().cast(PART))


def base_parts(text: Column) -> dict[str, Column]:
    """The base spans of each kind."""
    found = {kind: matches(text, pattern) for kind, pattern in BASE.items()}
    found["assign"] = F.filter(found["assign"], lambda s: F.length(F.regexp_extract(s["value"], _VALUE, 1)) >= LEAST_VALUE)
    return found


def _label(kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"))


def _ranks(*kinds: str) -> Column:
    return F.col("rank").isin([KINDS.index(k) for k in kinds])


def _parts(docs: DataFrame) -> DataFrame:
    """One narrow row per document: base spans, weak spans and the starts of scopes
    (the last two only where the text holds complementary parts)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = base_parts(F.col("body"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("body")).withColumn("uid", F.monotonically_increasing_id())
    rows = rows.withColumns({k: F.transform(c, _label(k)) for k, c in base.items()})
    rows = rows.withColumns({k: F.transform(matches(F.col("body"), p), _label(k)) for k, p in WEAK.items()})
    identifiers, secrets = F.size("login") + F.size("access"), F.size("weak") + F.size("assign") + F.size("hex")
    weak = F.size("login") + F.size("weak") + F.size("endpoint")
    linked = (weak > 0) & (secrets > 0) & (identifiers + F.size("endpoint") > 0)
    breaks = F.transform(matches(F.col("body"), BLANK_LINE), lambda s: s["end"])
    return rows.select(
        "uid", "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE),
        F.array_sort(F.concat(*(F.col(k) for k in BASE))).alias("base"),
        F.when(linked, F.concat(*(F.col(k) for k in WEAK))).alias("weak"),
        F.when(linked, F.concat(F.array(F.lit(0)), breaks)).alias("scopes"))


def _tiles(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(F.greatest(start, F.lit(0)) / REACH), F.floor(end / REACH)))


def _overlapping(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Interval join: the rows of ``left`` (uid, start, rank, end, ...) once for
    each row of ``right`` of the same ``by`` that they overlap, in each tile that
    both touch."""
    a = left.withColumn("tile", _tiles(F.col("start"), F.col("end") - 1))
    b = right.select(*by, F.col("start").alias("start_"), F.col("end").alias("end_"), F.col("rank").alias("rank_"),
                     _tiles(F.col("start"), F.col("end") - 1).alias("tile"))
    return a.join(b, [*by, "tile"]).where((F.col("start") < F.col("end_")) & (F.col("start_") < F.col("end")))


def linked_parts(parts: DataFrame) -> DataFrame:
    """(uid, start, rank, end) of the weak parts that complementary parts support."""
    span = F.array_distinct(F.concat("base", "weak"))
    wanted = parts.where(F.col("weak").isNotNull())
    spans = wanted.select("uid", F.inline(span))
    # scopes: intervals from one start to the next; a part belongs to the one that holds its first character
    starts = F.col("scopes")
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.lit(2**31 - 1)))
    last = F.array_max(F.transform(span, lambda s: s["end"]))
    scopes = wanted.select("uid", last.alias("last"), F.inline(F.arrays_zip(starts.alias("from"), ends.alias("to")))) \
        .where(F.col("from") < F.col("last")) \
        .select("uid", "from", "to", _tiles(F.col("from"), F.least(F.col("to"), F.col("last")) - 1).alias("tile"))
    held = spans.withColumn("tile", F.floor(F.col("start") / REACH)).join(scopes, ["uid", "tile"]) \
        .where((F.col("from") <= F.col("start")) & (F.col("start") < F.col("to"))) \
        .select("uid", "start", "rank", "end", F.col("from").alias("scope"))
    base = held.where(_ranks(*BASE))
    weak = held.where(_ranks(*WEAK))
    key = ["uid", "start", "rank", "end", "scope"]
    # base spans win over weak parts, an endpoint over a weak secret inside it
    covered = _overlapping(weak, base.unionByName(weak.where(_ranks("endpoint"))), ["uid"]) \
        .where((F.col("rank_") < len(BASE)) | (F.col("rank") == KINDS.index("weak"))).select(*key).distinct()
    free = weak.join(covered, key, "left_anti")
    partners = base.unionByName(free)
    near = free.withColumns({"low": F.col("start") - REACH, "high": F.col("end") + REACH})
    a = near.withColumn("tile", _tiles(F.col("low"), F.col("high")))
    b = partners.select("uid", "scope", F.col("start").alias("start_"), F.col("end").alias("end_"), F.col("rank").alias("rank_"),
                        _tiles(F.col("start"), F.col("end") - 1).alias("tile"))
    pairs = a.join(b, ["uid", "scope", "tile"]).where(
        ((F.col("end_") <= F.col("start")) | (F.col("start_") >= F.col("end")))
        & (F.col("end_") >= F.col("low")) & (F.col("start_") <= F.col("high")))
    mine, other = F.col("rank"), F.col("rank_")
    weak_rank = KINDS.index("weak")
    secret = other.isin([KINDS.index(k) for k in ("assign", "hex", "weak")])
    company = other.isin([KINDS.index(k) for k in ("access", "login", "endpoint")])
    return pairs.where(F.when(mine == weak_rank, company).otherwise(secret)).select("uid", "start", "rank", "end").distinct()


def _written(spans: Column) -> Column:
    kind = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans
    (kind:start:end, comma-joined), n_linked (weak parts reported)."""
    path = scratch_path(docs.sparkSession, "secret-parts")
    _parts(docs).write.parquet(path)
    parts = docs.sparkSession.read.parquet(path)
    linked = linked_parts(parts).groupBy("uid").agg(F.collect_list(F.struct("start", "rank", "end")).alias("linked"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    rows = parts.select("uid", "doc_id", "n_assign", "n_access", "n_hex", "base").join(linked, "uid", "left")
    found = F.coalesce("linked", none)
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                       _written(F.array_sort(F.concat("base", found))).alias("spans"), F.size(found).cast("long").alias("n_linked"))
