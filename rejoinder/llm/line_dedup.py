"""Near-duplicate lines by an exact set-similarity join, in DataFrame operations alone.

A line's tokens are its distinct words, in lower case, parted by spaces and tabs. A line
with any is removed if an earlier line (by document id, then line number) has a Jaccard
similarity of ``PERCENT`` percent or more with it, whether that line stays or not.

1. Rarity: words are counted over all texts in a table of ``COUNTERS`` hashed counters,
   whose size is fixed. Any order of tokens is right for what follows; rare ones first
   make it fast.
2. Lines with equal token sets form a class, represented by its first line. Equal lines
   are combined before the shuffle, so a line that is a third of all rows is one row per
   task. With too few tokens for one of them to differ, lines are similar only if equal, and
   take no part in what follows.
3. Prefixes: two similar lines share one of their rarest tokens (prefix filter). In
   dense groups each line is first compared with one line per frequent prefix token, its
   leader; what matches is settled. Only lines that are still open are joined with all
   others. The join tests length, position of the shared token, and 64-bit pictures of
   both token sets, of all tokens and in long lines of a quarter, of which bits that one
   side lacks each stand for a missing token.
4. Pairs that pass are verified on the words themselves, read again from the texts. Fixed
   tables of bits tell which texts and lines are needed, so the others are not shuffled.
   Distinct words are found once per line, so that a pair only costs their intersection.

The bounds on similarity are exact; hashes of tokens are only used to find candidates,
and, 56 bits of each, in the 128-bit name of a token set.

Null and empty texts have no lines to remove, and blank lines stay. A very long line is one
row, and a very long text as many rows as it has lines. Rows without an id stay as they are. Lines
at the same place of repeated rows are not earlier than each other: both are judged
alike. Columns other than id and text pass through ``drop_lines`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from rejoinder.llm.frames import discard, saved

PERCENT = 90
COUNTERS = 1 << 16
BITS = 1 << 23
LINES = 1 << 31  # more than a text has
LEADER_ROWS = 64
FULL = 64  # tokens; up to here the first picture is enough
_HASHES = {"parquet.enable.dictionary": "false"}  # hardly any value comes twice


def _spaced(line: str) -> str:
    return f"lower(if(contains({line}, '\\t') or contains({line}, '\\r'), translate({line}, '\\t\\r', '  '), {line}))"


def _words(line: str) -> Column:
    return F.expr(f"array_remove(array_distinct(split({_spaced(line)}, ' ')), '')")


def _lines(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def _rarity(docs: DataFrame) -> str:
    """For each counter a level up to 127 that rises with the logarithm of its count."""
    texts = docs.filter("doc_id IS NOT NULL").select(F.lower(F.replace("text", F.lit("\n"), F.lit(" "))).alias("text"))
    words = texts.select(F.explode(F.split("text", " ")).alias("word"))
    counts = words.groupBy((F.xxhash64("word").bitwiseAND(COUNTERS - 1)).alias("b")).count().collect()
    table = [0] * COUNTERS
    for row in counts:  # one row per counter, at most COUNTERS
        table[row["b"]] = min(127, int(3 * math.log2(row["count"])))
    return ",".join(map(str, table))


def _ranked(docs: DataFrame, percent: int) -> DataFrame:
    """Lines with the name of their token set, its size, prefix of rarest tokens and picture."""
    levels = F.split(F.lit(_rarity(docs)), ",").cast("array<bigint>")  # folded to one constant

    def rank(x: Column) -> Column:
        # Rarest first: the level above 56 bits of the hash. Few steps, for each is interpreted word by word.
        level = F.get(levels, x.bitwiseAND(COUNTERS - 1).cast("int"))
        return F.shiftleft(level, 56).bitwiseOR(F.shiftrightunsigned(x, 8))

    lines = _lines(docs).filter(F.octet_length("line") > 0)
    words = F.split(F.expr(_spaced("line")), " ")
    hashes = F.array_remove(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))
    hashes = F.sort_array(F.transform(hashes, rank))
    # Exploding a list of one keeps the filter below from hashing every line a second time.
    tokens = lines.select("doc_id", "line_no", F.explode(F.array(hashes)).alias("h"))
    # Sets of n and n + 1 tokens are the most alike of those that differ, at n to n + 1.
    may_differ = f"size(h) * {100 - percent} >= {percent}"
    prefix = F.slice("h", 1, F.expr(f"if({may_differ}, cast(size(h) - ({percent} * size(h) + 99) div 100 + 1 as int), 0)"))
    # A shift by a whole number goes by its last six bits.
    picture = "aggregate(h, 0L, (a, x) -> a | shiftleft(1L, cast(shiftright(x, 40) as int)))"
    # Lines of many words fill a picture; one of a quarter of their words still tells them apart.
    sparse = f"if(size(h) > {FULL}, aggregate(h, 0L, (a, x) -> if(x & 3 = 0, a | shiftleft(1L, cast(shiftright(x, 34) as int)), a)), 0L)"
    return tokens.filter(F.size("h") > 0).select(
        F.xxhash64("h").alias("h1"), F.xxhash64(F.lit(1), "h").alias("h2"), "doc_id", "line_no",
        F.size("h").alias("n"), prefix.alias("prefix"), F.expr(picture).alias("picture"), F.expr(sparse).alias("sparse"),
    )


def _classes(ranked: DataFrame) -> DataFrame:
    """One row per token set, with the place of its first line and whether it has others.

    What depends on the name alone is part of the key, and the place is one number if ids are
    whole: so Spark combines rows in a hash table, where a struct or list among the values
    makes it sort them.
    """
    kind = ranked.schema["doc_id"].dataType
    if isinstance(kind, IntegralType):
        place = F.expr(f"cast(doc_id as decimal(20)) * {LINES} + line_no")
        line_no = f"pmod(at, {LINES})"
        doc_id = f"cast((at - {line_no}) div {LINES} as {kind.simpleString()})"
    else:
        place, doc_id, line_no = F.struct("doc_id", "line_no"), "at.doc_id", "at.line_no"
    found = ranked.groupBy("h1", "h2", "n", "prefix", "picture", "sparse").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("rows"))
    return found.select(
        "h1", "h2", F.expr(doc_id).alias("doc_id"), F.expr(f"cast({line_no} as int)").alias("line_no"),
        "n", "prefix", "picture", "sparse", (F.col("rows") > 1).alias("several"),
    )


def _prefix_rows(classes: DataFrame, side: str, shorter: str | None = None) -> DataFrame:
    rows = classes.select("doc_id", "line_no", "n", "picture", "sparse", F.posexplode("prefix").alias("i", "token"))
    rows = rows.filter(shorter) if shorter else rows
    return rows.select("token", *(F.col(c).alias(side + c) for c in ("doc_id", "line_no", "n", "picture", "sparse", "i")))


def _shorter_prefix(percent: int, side: str = "") -> str:
    """That a token lies in the prefix which suffices for the shorter line of a pair."""
    total = 100 + percent
    return f"{side}i < {side}n - ({2 * percent} * {side}n + {total - 1}) div {total} + 1"


def _possible(percent: int) -> str:
    """That lines ``x`` and ``y`` can be similar, by length and pictures."""
    total = 100 + percent
    need = f"{percent} * (xn + yn)"
    seen, sparse = (
        " AND ".join(f"{total} * ({a}n - bit_count({a}{c} & ~{b}{c})) >= {need}" for a, b in ("xy", "yx")) for c in ("picture", "sparse")
    )
    return f"100 * least(xn, yn) >= {percent} * greatest(xn, yn) AND {seen} AND (least(xn, yn) <= {FULL} OR ({sparse}))"


_EARLIER = "(xdoc_id < ydoc_id OR (xdoc_id = ydoc_id AND xline_no < yline_no))"
_PAIR = ["xdoc_id", "xline_no", "ydoc_id", "yline_no"]


def _with_leaders(classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of a line ``y`` and the leader ``x`` of a frequent prefix token: its first line."""
    rows = _prefix_rows(classes, "y", _shorter_prefix(percent))
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("rows"), F.min("ydoc_id").alias("xdoc_id"))
    frequent = saved(counts.filter(F.col("rows") > LEADER_ROWS).drop("rows"), "frequent-tokens")
    own = rows.join(frequent, "token").filter("ydoc_id = xdoc_id")
    first = own.groupBy("token", "xdoc_id").agg(F.min(F.struct("yline_no", "yn", "ypicture", "ysparse")).alias("m"))
    leaders = saved(first.select("token", "xdoc_id", *(F.col(f"m.y{c}").alias(f"x{c}") for c in ("line_no", "n", "picture", "sparse"))), "line-leaders")
    return rows.join(leaders, "token").filter(f"{_EARLIER} AND {_possible(percent)}").select(*_PAIR).distinct()


def _with_all(classes: DataFrame, open_classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of an open line ``y`` and any earlier line ``x``."""
    total = 100 + percent
    roles = (
        f"((xn <= yn AND {_shorter_prefix(percent, 'x')}) OR (xn >= yn AND {_shorter_prefix(percent, 'y')}))"
        f" AND {total} * least(xn - xi, yn - yi) >= {percent} * (xn + yn)"
    )
    pairs = _prefix_rows(open_classes, "y").join(_prefix_rows(classes, "x"), "token")
    return pairs.filter(f"{_EARLIER} AND {_possible(percent)} AND {roles}").select(*_PAIR).distinct()


def _may_be_among(rows: DataFrame, needed: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose ``keys`` may be among the needed, by a table of ``BITS`` bits over the keys' hashes.

    The table has at most ``BITS`` / 64 rows, so its broadcast is bounded.
    """
    place = F.xxhash64(*keys).bitwiseAND(BITS - 1)
    word, bit = F.expr("cast(p div 64 as int)").alias("w"), F.expr("cast(p & 63 as int)").alias("bit")
    marked = needed.select(place.alias("p")).select(word, bit).groupBy("w").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("m"))
    found = rows.withColumn("p", place).select("*", word, bit)
    return found.join(F.broadcast(marked), "w").filter("getbit(m, bit) = 1").select(rows.columns)


def _needed_lines(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """The lines that may be among the needed; texts without any are not parted."""
    return _may_be_among(_lines(_may_be_among(docs, needed, ["doc_id"])), needed, ["doc_id", "line_no"])


def _verified(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The lines ``doc_id, line_no`` among ``y`` whose words are similar to those of their ``x``."""
    ends = [pairs.select(F.col(f"{s}doc_id").alias("doc_id"), F.col(f"{s}line_no").alias("line_no")) for s in "xy"]
    needed = saved(ends[0].union(ends[1]).distinct(), "lines-needed")
    lines = _needed_lines(docs, needed).join(needed.hint("merge"), ["doc_id", "line_no"])
    lines = lines.dropDuplicates(["doc_id", "line_no"])
    # Exploding a list of one keeps the lines from being parted again for every use.
    lines = lines.select("doc_id", "line_no", F.explode(F.array(_words("line"))).alias("words"))
    # A line's distinct words travel as text: a list of words takes several times the bytes in a shuffle.
    lines = saved(lines.select("doc_id", "line_no", F.size("words").alias("n"), F.array_join("words", " ").alias("line")), "line-texts")
    x, y = (lines.select(*(F.col(c).alias(s + c) for c in lines.columns)) for s in "xy")
    both = pairs.join(x, ["xdoc_id", "xline_no"]).join(y, ["ydoc_id", "yline_no"])
    # Lines meet in several pairs: only what needs both of them is done here, and once.
    shared = F.size(F.array_intersect(F.split("xline", " "), F.split("yline", " ")))
    similar = both.filter((100 + percent) * shared >= percent * (F.col("xn") + F.col("yn")))
    return similar.select(F.col("ydoc_id").alias("doc_id"), F.col("yline_no").alias("line_no")).distinct()


def repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, line_no`` (from 0) of the lines to remove, from ``doc_id, text``."""
    texts = docs.select("doc_id", "text")
    ranked = saved(_ranked(texts, percent), "lines", **_HASHES)
    classes = saved(_classes(ranked), "line-classes", **_HASHES)
    place = ["doc_id", "line_no"]
    pairs = saved(_with_leaders(classes, percent), "leader-pairs")
    first = saved(_verified(texts, pairs, percent), "lines-settled")
    discard(pairs)
    still = classes.join(first, place, "left_anti")
    pairs = saved(_with_all(classes, still, percent), "line-pairs")
    second = saved(_verified(texts, pairs, percent), "lines-similar")
    discard(pairs)
    # A class's later lines go in any case, its first one if it is similar to an earlier line.
    firsts = classes.filter("several").select("h1", "h2", *(F.col(c).alias("first_" + c) for c in place))
    lines = ranked.select("h1", "h2", *place).join(firsts, ["h1", "h2"])
    later = lines.filter("doc_id > first_doc_id OR (doc_id = first_doc_id AND line_no > first_line_no)")
    # Dealt by document, for what follows goes by document as well.
    return later.select(*place).union(first).union(second).repartition("doc_id").distinct()


def line_report(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``doc_id, n_lines, removed`` (line numbers, rising) for each row."""
    lists = removed.groupBy("doc_id").agg(F.sort_array(F.collect_list("line_no")).alias("removed"))
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    counted = docs.select("doc_id", F.coalesce(breaks + 1, F.lit(0)).alias("n_lines"))
    empty = F.array().cast("array<int>")
    return counted.join(lists, "doc_id", "left").withColumn("removed", F.coalesce("removed", empty))


def drop_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """The rows with all their columns, their ``text`` without the removed lines.

    A column ``n_chars``, if there is one, follows the text. A document all of whose words
    stood in removed lines is left out.
    """
    lists = removed.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list("line_no").alias("__removed"))
    joined = docs.join(lists, docs["doc_id"] == F.col("__id"), "left")
    kept = F.expr(
        "transform(array(split(text, '\n', -1)), lines -> array_join(transform("
        "array_except(sequence(0, size(lines) - 1), __removed), i -> lines[i]), '\n'))[0]"
    )
    changed = F.col("__removed").isNotNull()
    new = {"text": F.when(changed, kept).otherwise(docs["text"])}
    joined = joined.withColumns(new).filter(~changed | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return joined.select(docs.columns)
