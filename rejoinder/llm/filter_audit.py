"""What each of several filters removes, in every order in which they could be applied.

A document is reduced to its failure mask: one bit per filter. Spark counts documents, and
good and toxic ones among them, per part and mask, with partial counts before the shuffle, so
that a part brings at most ``2 ** filters`` counts for each kind of document to the task that
audits it, however many documents it has.

That task builds one decision diagram per part. A level is a filter, a node a set of masks
told apart by the filters above it, its two edges go to those that pass and those that fail,
and its weight is the count of documents below it. Nodes with equal children are one. To come
from one order to the next, two adjacent levels are swapped, which only touches the nodes of
these two; all orders are walked by such swaps. The path along the passing edges gives the
steps of an order: a node's weight is what arrives, its failing edge what is removed there.
What a filter removes as the first one is all that fails it; what it removes as the last one
fails it alone.

``FILTERS`` (words are runs of characters other than ASCII white space): A, under 200 words;
B, fewer than half of the words distinct; C, more than 2 % of the code points in A-Z; D, holds
one of ``#$%&*|``; E, the text is that of a document with a smaller id, whatever its part and
whether that one is removed or not.

A null text is empty, a null part is the part ''. A document without an id passes E and
makes no other fail it; rows that repeat an id and text are all counted, and are no reason
to fail E for each other. A document is good (toxic) if any label of its id says so; those without a label
or an id are neither. Very long texts are read in pieces of ``PIECE`` bytes; only the set of
their distinct words is held. An empty table has no parts and gives no rows. Other columns
are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.frames import saved

FILTERS = "ABCDE"
PIECE = 1 << 24

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SIGNS = re.compile(rb"[#$%&*|]")
_UPPER = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))

_STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)
_NAMES = [field.split()[0] for field in _STEPS.split(", ")]

Count = tuple[int, ...]


# --- the filters -------------------------------------------------------------


def _pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The text cut at white space, each piece of at least ``size`` bytes but the last."""
    begin = 0
    while len(text) - begin > size:
        cut = _SPACE.search(text, begin + size)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def text_mask(text: bytes, piece: int = PIECE) -> int:
    """The bits of A to D that a text in UTF-8 fails, A the lowest."""
    n_words, words = 0, set()
    for part in _pieces(text, piece):
        found = part.split()
        n_words += len(found)
        words.update(found)
    n_points = len(text.translate(None, _CONTINUED))
    n_upper = len(text) - len(text.translate(None, _UPPER))
    fails = (n_words < 200, 100 * len(words) < 50 * n_words, 100 * n_upper > 2 * n_points, bool(_SIGNS.search(text)))
    return sum(1 << i for i, fail in enumerate(fails) if fail)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks, keys = [], []
        for value in batch.column("text").cast(pa.large_binary()):
            text = value.as_py() or b""
            masks.append(text_mask(text))
            keys.append(hashlib.blake2b(text, digest_size=16).digest())
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(keys, pa.binary())],
            names=["doc_id", "part", "mask", "key"],
        )


def _labelled(labels: DataFrame) -> DataFrame:
    def any_of(name: str) -> Column:
        return F.max(F.coalesce(F.col(name) == 1, F.lit(False)).cast("int")).alias(name)

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").filter("doc_id IS NOT NULL")
    return known.groupBy("doc_id").agg(any_of("quality"), any_of("toxic"))


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, quality, toxic`` for each document.

    Copies are found by 128-bit hashes. Only texts that more than one document has are
    joined back, on the hash. They and the labels are written first: AQE splits the documents of a
    very frequent text or id only where both sides of the join come straight from a shuffle.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), "text")
    read = saved(own.mapInArrow(_masks, "doc_id long, part string, mask int, key binary"), "masks")
    least = read.groupBy("key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    copies = read.join(saved(least, "copied-texts"), "key", "left")
    repeats = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int")
    masked = copies.select("doc_id", "part", (F.col("mask") + F.lit(16) * repeats).alias("mask"))
    found = masked.join(saved(_labelled(labels), "labels"), "doc_id", "left")
    return found.select("part", "mask", *(F.coalesce(F.col(n), F.lit(0)).alias(n) for n in ("quality", "toxic")))


# --- the diagram -------------------------------------------------------------


class Diagram:
    """A decision diagram over failure masks whose leaves are counts.

    ``order[i]`` is the filter of level ``i``; ``levels[i]`` holds its nodes as pairs of
    places on the next level, passing edge first; ``weights[i]`` their counts. The last
    level holds the distinct leaves.
    """

    def __init__(self, n_filters: int, counts: dict[int, Count], zero: Count):
        self.order = list(range(n_filters))
        self.levels: list[list[tuple[int, int]]] = [[] for _ in range(n_filters)]
        self.weights: list[list[Count]] = [[] for _ in range(n_filters)]
        leaves: dict[Count, int] = {}
        below = [leaves.setdefault(counts.get(mask, zero), len(leaves)) for mask in range(1 << n_filters)]
        self.weights.append(list(leaves))
        # The mask's lowest bit is the top level: the two halves of the list are the last level's edges.
        for level in range(n_filters - 1, -1, -1):
            half = len(below) // 2
            below = self._unique(level, list(zip(below[:half], below[half:])))

    def _unique(self, level: int, nodes: Sequence[tuple[int, int]]) -> list[int]:
        """Makes the distinct ones of ``nodes`` the level's; returns the place of each."""
        places: dict[tuple[int, int], int] = {}
        found = [places.setdefault(node, len(places)) for node in nodes]
        self.levels[level] = list(places)
        self._weigh(level)
        return found

    def _weigh(self, level: int) -> None:
        below = self.weights[level + 1]
        self.weights[level] = [tuple(a + b for a, b in zip(below[low], below[high])) for low, high in self.levels[level]]

    def swap(self, level: int) -> None:
        """Exchanges a level with the next. Its nodes keep their places, so those above stay as they are."""
        below = self.levels[level + 1]
        crossed = []
        for low, high in self.levels[level]:
            (pass_pass, pass_fail), (fail_pass, fail_fail) = below[low], below[high]
            crossed += [(pass_pass, fail_pass), (pass_fail, fail_fail)]
        places = self._unique(level + 1, crossed)
        self.levels[level] = list(zip(places[::2], places[1::2]))
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def passing(self) -> list[tuple[int, Count, Count]]:
        """Filter, counts kept and counts removed of each step of the present order."""
        steps, node = [], 0
        for level, name in enumerate(self.order):
            low, high = self.levels[level][node]
            steps.append((name, self.weights[level + 1][low], self.weights[level + 1][high]))
            node = low
        return steps


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap with the next, one after another, so that every order of ``n`` is met once."""
    if n < 2:
        return
    down = True
    for inner in [*adjacent_swaps(n - 1), None]:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if inner is not None:
            yield inner + down  # the largest is at the front after a way down
        down = not down


def audit_part(counts: dict[int, Count], filters: str = FILTERS) -> list[tuple[str, int, int, int, int, int, int, int, int]]:
    """The rows of one part, from counts ``(documents, good, toxic)`` by mask."""
    diagram = Diagram(len(filters), counts, (0, 0, 0))
    walked = {tuple(diagram.order): diagram.passing()}
    for level in adjacent_swaps(len(filters)):
        diagram.swap(level)
        walked[tuple(diagram.order)] = diagram.passing()
    failing, alone, shapley = {}, {}, dict.fromkeys(range(len(filters)), 0)
    for steps in walked.values():
        failing[steps[0][0]] = steps[0][2][0]
        alone[steps[-1][0]] = steps[-1][2][0]
        for name, _, removed in steps:
            shapley[name] += removed[0]
    rows = []
    for order, steps in walked.items():
        named = "".join(filters[name] for name in order)
        for step, (name, kept, removed) in enumerate(steps, 1):
            rows.append((named, step, kept[0], removed[0], failing[name] - removed[0], alone[name], *removed[1:], shapley[name]))
    return rows


def _audit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    counts = dict(zip(table["mask"].to_pylist(), zip(*(table[c].to_pylist() for c in ("n", "quality", "toxic")))))
    rows = audit_part(counts)
    columns = [pa.array(c, pa.int32() if i == 1 else pa.string() if not i else pa.int64()) for i, c in enumerate(zip(*rows))]
    return pa.table([pa.array([key[0].as_py()] * len(rows), pa.string()), *columns], names=_NAMES)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, as ``_STEPS`` names them."""
    masks = failure_masks(docs, labels)
    totals = [F.sum(F.col(name).cast("long")).alias(name) for name in ("quality", "toxic")]
    counts = masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *totals)
    return counts.groupBy("part").applyInArrow(_audit, _STEPS)
