"""Line dedup by a log-template tree of fixed depth.

A line (of a text split at ``\\n``) is its white-space tokens; those with a digit
are variable from the start (``<*>``). The tree has the token count first, then
the ``LEADING`` first tokens; a leaf holds the lines that agree in these. In
each leaf a place whose most frequent token covers less than ``FIXED`` of the
leaf's distinct lines is a variable field. A line that agrees with the leaf in
every other place has the leaf's template if at most ``VARIABLE`` of its places
are variable and it is fixed enough: ``LEAST_FIXED`` tokens or more agree, and
more than half of the places after the leading ones. So lines that merely open
alike have no template in common. Any other line is its own template.

Several templates, or one beside ordinary lines, may share a leaf. So a line also
has forms, which don't depend on what else the leaf holds: its places after the
leading ones are cut into ``BLOCKS`` runs (single places, if there are no more),
and in each form one to ``MOST_WILD`` of the runs are open. Forms must be fixed
enough too, so they find every template of lines of up to ``LEADING + BLOCKS``
tokens. In longer lines, templates whose fields spread over more than
``MOST_WILD`` of the runs are found by the rule of the leaf alone. Runs that no
other line of the leaf holds are open in every form of a line.

Templates of at least
``LEAST_TOKENS`` tokens found in ``RECURS`` distinct texts or more recur, and
their lines are dropped from every text; so are the lines of forms found in as
many. Exact copies of a text count as one
text; lines of fewer tokens stay, and so do lines with a digit in more than
``VARIABLE`` of their tokens, whose template would say nothing.

Only DataFrame functions. Lines travel as hashes; words of lines move only for
leaves that hold several distinct lines. All counts are sums with map-side
partial sums, so a line that a third of the texts hold is no hot group.

Null text counts as empty (no lines). Dropping depends on texts alone, so ids
may be null or repeat; extra columns are kept by ``drop_template_lines``. Lines
are counted by 64-bit hashes. Empty in, empty out."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

LEADING = 3
LEAST_TOKENS = 4
RECURS = 4
LEAST_FIXED = 6
FIXED = 0.6
VARIABLE = 0.4
BLOCKS, MOST_WILD = 8, 3
BROADCAST_ROWS = 2_000_000  # of one long each

_BLANK = r"[\x20\x09\x0B-\x0D]++"
_VARIABLE = r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+"
_TRIM = " \t\x0b\x0c\r"


def _text_key(text: Column) -> Column:
    return F.xxhash64(text, F.length(text))


def _masked_lines(text: Column) -> Column:
    """The lines of a text: tokens parted by one space, variable ones masked."""
    plain = F.regexp_replace(F.regexp_replace(text, _BLANK, " "), _VARIABLE, "<*>")
    plain = F.replace(F.replace(plain, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    return F.split(F.btrim(plain), "\n", -1)


def _occurrences(line: Column, part: str) -> Column:
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(part), F.lit("")))) / len(part)


def _lines(docs: DataFrame) -> DataFrame:
    """text_key, place, leaf, line (hashes) of lines of enough fixed tokens."""
    text = F.coalesce("text", F.lit(""))
    # key and masks before the explode: beside it they would be made for each line
    rows = docs.select(_text_key(text).alias("text_key"), _masked_lines(text).alias("lines"))
    # outer: the others get a filter on the array, which would mask each text twice
    rows = rows.select("text_key", F.posexplode_outer("lines").alias("place", "masked"))
    n = _occurrences(F.col("masked"), " ").cast("int") + 1
    rows = rows.withColumn("n", n).where((F.col("n") >= LEAST_TOKENS) & (_occurrences(F.col("masked"), "<*>") <= VARIABLE * F.col("n")))
    return rows.select("text_key", "place", F.xxhash64("n", F.substring_index("masked", " ", LEADING)).alias("leaf"),
                       F.xxhash64("masked", "n").alias("line"))


def _checked(keys: DataFrame) -> DataFrame:
    """Checkpointed ``keys``, broadcast if they are few enough; joined by a
    shuffle otherwise."""
    keys = keys.checkpoint()
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _read(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """leaf, line, lines (of the leaf), tokens (hashes): the distinct lines of
    leaves that hold several, each read from one text. ``lines``: text_key,
    place, leaf, line."""
    distinct = lines.groupBy("leaf", "line").agg(F.min(F.struct("text_key", "place")).alias("at"))
    shared = lines.select("leaf", "line").distinct().groupBy("leaf").agg(F.count("*").alias("lines")).where("lines >= 2")
    wanted = (distinct.join(shared, "leaf").groupBy(F.col("at.text_key").alias("text_key"))
              .agg(F.collect_list(F.struct("at.place", "leaf", "line", "lines")).alias("wanted"))).checkpoint()
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(_text_key(text).alias("text_key"), text.alias("text")).join(_checked(wanted.select("text_key")), "text_key", "left_semi")
    read = (texts.join(wanted, "text_key")
            .select("wanted", F.explode_outer(F.array(_masked_lines(F.col("text")))).alias("masked"))  # made once
            .select(F.explode_outer(F.transform("wanted", lambda w: F.struct(
                w["leaf"].alias("leaf"), w["line"].alias("line"), w["lines"].alias("lines"), F.get("masked", w["place"]).alias("masked")))).alias("x"))
            .select("x.*"))
    tokens = F.transform(F.split("masked", " "), lambda t: F.xxhash64(t))
    return read.dropDuplicates(["leaf", "line"]).select("leaf", "line", "lines", tokens.alias("tokens"))


def _general(read: DataFrame) -> DataFrame:
    """(leaf, line) pairs that have their leaf's template."""
    words = read.select("leaf", "line", "lines", F.posexplode_outer("tokens").alias("at", "token"))
    tokens = words.groupBy("leaf", "at", "token").agg(F.count("*").alias("n"), F.first("lines").alias("lines"))
    places = (tokens.groupBy("leaf", "at").agg(F.max(F.struct("n", "token")).alias("top"), F.first("lines").alias("lines"))
              .select("leaf", "at", F.when(F.col("top.n") >= FIXED * F.col("lines"), F.col("top.token")).alias("fixed")))
    agree = (words.join(places, ["leaf", "at"]).groupBy("leaf", "line")
             .agg(F.count("*").alias("n"), F.sum(F.col("fixed").isNull().cast("int")).alias("variable"),
                  F.sum((F.col("fixed") != F.col("token")).cast("int")).alias("other"),
                  F.sum((F.col("fixed") != _masked()).cast("int")).alias("all_fixed"),
                  F.sum(((F.col("at") >= LEADING) & (F.col("fixed") != _masked())).cast("int")).alias("later_fixed")))
    enough = (F.col("all_fixed") >= LEAST_FIXED) & (2 * F.col("later_fixed") > F.col("n") - LEADING)
    return agree.where((F.col("variable") <= VARIABLE * F.col("n")) & (F.coalesce("other", F.lit(0)) == 0) & enough).select("leaf", "line")


def _masked() -> Column:
    return F.xxhash64(F.lit("<*>"))


def _runs(read: DataFrame) -> DataFrame:
    """leaf, line, n, lead (fixed tokens among the leading), and of each run its
    key and its number of fixed tokens; ``held`` has the bits of those with places."""
    n = F.size("tokens")
    start = [F.when(n - LEADING >= BLOCKS, F.floor(F.lit(b) * (n - LEADING) / BLOCKS)).otherwise(F.least(F.lit(b), n - LEADING)).cast("int")
             for b in range(BLOCKS + 1)]
    run = [F.slice("tokens", start[b] + LEADING + 1, start[b + 1] - start[b]) for b in range(BLOCKS)]
    fixed = lambda tokens: F.size(F.filter(tokens, lambda t: t != _masked()))
    made = F.struct(n.alias("n"), fixed(F.slice("tokens", 1, LEADING)).alias("lead"),
                    F.array(*(F.xxhash64("leaf", F.lit(b), run[b]) for b in range(BLOCKS))).alias("keys"),
                    F.array(*map(fixed, run)).alias("fixed"),
                    sum((F.when(start[b + 1] > start[b], 1 << b).otherwise(0) for b in range(BLOCKS)), F.lit(0)).alias("held"))
    return read.select("leaf", "line", F.explode_outer(F.array(made)).alias("r")).select("leaf", "line", "r.*")


def _forms() -> Column:
    """Hashes of a line's forms. ``held`` and ``shared`` are bits of the runs that
    have places, and that other lines hold too."""
    masks = [sum(1 << b for b in c) for k in range(1, MOST_WILD + 1) for c in combinations(range(BLOCKS), k)]
    closed = lambda mask, b: mask.bitwiseAND(F.lit(1 << b)) == 0

    def fits(mask):
        later = sum((F.when(closed(mask, b), F.get("fixed", F.lit(b))).otherwise(0) for b in range(BLOCKS)), F.lit(0))
        some = mask.bitwiseAND(F.bitwise_not("held")) == 0
        own = F.col("held").bitwiseAND(F.bitwise_not("shared")).bitwiseAND(F.bitwise_not(mask)) == 0
        return (some & own & (later + F.col("lead") >= LEAST_FIXED) & (2 * later > F.col("n") - LEADING)
                & (F.col("n") - later - F.col("lead") <= VARIABLE * F.col("n")))

    def key(mask):
        return F.xxhash64("leaf", mask, *(F.when(closed(mask, b), F.get("keys", F.lit(b))).otherwise(F.lit(0)) for b in range(BLOCKS)))

    return F.transform(F.filter(F.array(*map(F.lit, masks)), fits), key)


def _of_forms(read: DataFrame, held: DataFrame, recurs: int) -> DataFrame:
    """(leaf, line) pairs of forms that ``recurs`` texts hold. ``held``: leaf,
    line, text_key, distinct."""
    runs = _runs(read).checkpoint()
    texts = held.groupBy("leaf", "line").agg(F.count("*").alias("texts"))
    parts = runs.select("leaf", "line", F.posexplode_outer("keys").alias("b", "key"))
    # the sum is the most that can hold a form with the run closed
    common = (parts.join(texts, ["leaf", "line"]).groupBy("key").agg(F.count("*").alias("lines"), F.sum("texts").alias("texts"))
              .where((F.col("lines") >= 2) & (F.col("texts") >= recurs)).select("key"))
    shared = (parts.join(_checked(common), "key", "left_semi").groupBy("leaf", "line")
              .agg(F.sum(F.expr("shiftleft(1, b)")).cast("int").alias("shared")))
    rows = runs.join(shared, ["leaf", "line"])
    rows = rows.where(F.bit_count(F.col("held").bitwiseAND(F.bitwise_not("shared"))) <= MOST_WILD).checkpoint()
    forms = rows.select("leaf", "line", F.explode_outer(_forms()).alias("form")).where(F.col("form").isNotNull())
    # a line that recurs by itself is enough for its forms, whatever its texts are
    few = held.join(texts, ["leaf", "line"]).where(F.col("texts") < recurs).select("leaf", "line", "text_key", F.lit(1).alias("weight"))
    many = texts.where(F.col("texts") >= recurs).select("leaf", "line", F.col("line").alias("text_key"), F.lit(recurs).alias("weight"))
    often = (forms.join(few.union(many), ["leaf", "line"]).groupBy("form", "text_key").agg(F.max("weight").alias("weight"))
             .groupBy("form").agg(F.sum("weight").alias("texts")).where(F.col("texts") >= recurs).select("form"))
    return forms.join(_checked(often), "form", "left_semi").select("leaf", "line").distinct()


def recurring_lines(docs: DataFrame, recurs: int = RECURS) -> tuple[DataFrame, DataFrame]:
    """(lines of leaves that can recur: text_key, place, leaf, line), (leaf, line)
    pairs to drop. A leaf with fewer lines than ``recurs`` holds no template that
    recurs."""
    ensure_checkpoint_dir(docs.sparkSession)
    lines = _lines(docs).checkpoint()
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= recurs).select("leaf")
    lines = lines.join(_checked(leaves), "leaf", "left_semi").checkpoint()
    held = lines.select("leaf", "line", "text_key").distinct()
    read = _read(docs, lines).checkpoint()
    general = _general(read).withColumn("general", F.lit(True))
    template = F.when(F.col("general"), F.xxhash64("leaf", F.lit("leaf"))).otherwise(F.xxhash64("leaf", "line"))
    known = held.join(general, ["leaf", "line"], "left").select("leaf", "line", "text_key", template.alias("template")).checkpoint()
    often = (known.select("template", "text_key").distinct().groupBy("template").agg(F.count("*").alias("texts"))
             .where(F.col("texts") >= recurs).select("template"))
    recurring = known.select("leaf", "line", "template").distinct().join(often, "template", "left_semi").select("leaf", "line")
    return lines, recurring.union(_of_forms(read, held, recurs)).distinct()


def _with_dropped(docs: DataFrame, recurs: int) -> DataFrame:
    """The rows of ``docs`` (as c0, c1, ...) and ``dropped``: places of lines to drop."""
    lines, recurring = recurring_lines(docs.select("text"), recurs)
    dropped = (lines.select("text_key", "place", "leaf", "line").join(recurring, ["leaf", "line"], "left_semi")
               .groupBy("text_key").agg(F.collect_set("place").alias("dropped")))
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = F.coalesce(F.col(names[docs.columns.index("text")]), F.lit(""))
    return docs.toDF(*names).withColumn("text_key", _text_key(text)).join(dropped, "text_key", "left")


def _rest(text: Column) -> Column:
    """The lines of a text that stay."""
    return F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("dropped", i))


def drop_template_lines(docs: DataFrame, recurs: int = RECURS) -> DataFrame:
    """The rows of ``docs`` with its columns, recurring lines taken out of ``text``."""
    rows = _with_dropped(docs, recurs)
    names = dict(zip(docs.columns, rows.columns[1:] if rows.columns[0] == "text_key" else rows.columns))
    text = F.col(names["text"])
    new = F.when(F.col("dropped").isNull(), text).otherwise(F.array_join(_rest(text), "\n"))
    return rows.select(*((new if c == "text" else F.col(names[c])).alias(c) for c in docs.columns))


def template_report(docs: DataFrame, recurs: int = RECURS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines (with a token), n_dropped,
    text_sha256 of the cleaned text (null: empty)."""
    rows = _with_dropped(docs.select("doc_id", "text"), recurs)
    text = F.coalesce("c1", F.lit(""))
    cleaned = F.when(F.col("dropped").isNull(), text).otherwise(F.array_join(_rest(text), "\n"))
    n = F.size(F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(_TRIM))) > 0)).cast("long")
    return rows.select(F.col("c0").alias("doc_id"), n.alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                       F.sha2(cleaned, 256).alias("text_sha256"))
