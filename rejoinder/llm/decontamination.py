"""Documents that hold benchmark items, also reworded, by latent semantic retrieval.

1. Passages are runs of ``SEGMENT`` words. Their words are hashed to ``TERMS`` terms,
   whose counts C (passages by terms) are never stored: every task multiplies its rows with
   a fixed random matrix and back, Z = C' (C R), and counts the terms. Z is summed over
   the tasks, which all have the same fixed size.
2. With the weights D = log(passages / count) of the terms, D Z = (C D)' (C D) (R / D): the
   sketch of a randomised decomposition of the TF-IDF matrix, taken in one pass over all
   texts. Its leading ``RANK`` right singular vectors and values follow on the driver from
   matrices whose size does not depend on the data (Nystroem's formula).
3. In a second pass every window of two neighbouring passages is projected, scaled by the
   singular values, and compared by cosine with the windows of all benchmark items.
4. Pairs above ``COSINE`` are checked on their words: enough of the item's words must be
   near, their longest common subsequence must cover ``COVERED`` of the item in order, and
   ``ANSWERS`` of its rarest words (its answer words) must be there.
5. Whatever the cosine, the places of an item's pivots (so many of its answer words that a
   match must hold one) are checked alike, in a window of little more than the item's length.
   A copy word for word is thereby always found.

Items are read in slices of at most ``ITEM_BYTES``, one second pass per slice, so what a
task holds of them is bounded. Items with fewer than ``LEAST_WORDS`` words are held by a text
that has all their words in a run, and only then. Items in scripts without blanks are also
searched as a run of characters, ASCII letters in any case. Null and blank items are not
searched. A null or empty text matches nothing. Rows stay as they are, repeated or not, null ids included; other columns
are left out. Repeated items count once per row of the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.frames import text_bytes
from rejoinder.llm.hashing import LOWER, texts_in_chunks, word_hashes

SEGMENT = 16
TERMS = 1 << 15
RANK = 64
COSINE = 0.4
COVERED = 0.7
ANSWERS = 0.6
LEAST_WORDS = 8
ITEM_BYTES = 8 << 20
SHARDS = 32
SEED = 5
#: Thai, Lao, Burmese, Khmer, kana and Han: scripts that do not part words by blanks.
UNPARTED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_U = np.uint64


@lru_cache(maxsize=1)
def _random() -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(RANK, TERMS)).astype(np.float32)


@dataclass
class Passages:
    """The words of some texts in rows of ``SEGMENT``; a text's last row may be short."""

    words: np.ndarray  # 64-bit hashes, text after text
    before: np.ndarray  # words before each text
    terms: np.ndarray  # by passage and place; TERMS where there is no word
    text: np.ndarray  # of each passage
    first: np.ndarray  # passages before each text

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Passages:
        words, _, before = word_hashes(data, offsets)
        sizes = np.diff(before)
        counts = -(-sizes // SEGMENT)
        first = np.concatenate([[0], np.cumsum(counts)])
        text = np.repeat(np.arange(len(sizes)), counts)
        terms = np.full(first[-1] * SEGMENT, TERMS, np.int64)
        shift = first[:-1] * SEGMENT - before[:-1]
        terms[np.arange(len(words)) + np.repeat(shift, sizes)] = (words >> _U(44)).astype(np.int64) & (TERMS - 1)
        return cls(words, before, terms.reshape(-1, SEGMENT), text, first)


def _projected(terms: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Sums of the matrix' columns over the terms of each passage, row by row."""
    out = np.empty((len(matrix), len(terms)), np.float32)
    padded = np.zeros(TERMS + 1, np.float32)
    for r, row in enumerate(matrix):
        padded[:TERMS] = row
        out[r] = padded[terms].sum(axis=1)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """C' (C R) and the counts of the terms over a partition, in ``SHARDS`` rows."""
    total, counts, rows = np.zeros((RANK, TERMS)), np.zeros(TERMS, np.int64), 0
    for _, data, offsets in texts_in_chunks(batches, "text"):
        passages = Passages.of(data, offsets)
        flat = passages.terms.ravel()
        rows += len(passages.terms)
        counts += np.bincount(flat, minlength=TERMS + 1)[:TERMS]
        for r, row in enumerate(_projected(passages.terms, _random())):
            total[r] += np.bincount(flat, np.repeat(row, SEGMENT), TERMS + 1)[:TERMS]
    if rows:
        width = TERMS // SHARDS
        for s in range(SHARDS):
            part = slice(s * width, (s + 1) * width)
            values = [[s], [total[:, part].astype(np.float32).tobytes()], [counts[part].tobytes()], [rows]]
            yield pa.record_batch(
                [pa.array(values[0], pa.int32()), pa.array(values[1], pa.binary()), pa.array(values[2], pa.binary()), pa.array(values[3], pa.int64())],
                names=["shard", "z", "counts", "passages"],
            )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of all rows of a partition, shard by shard; at most ``SHARDS`` are held."""
    sums: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            z, counts = np.frombuffer(row["z"], np.float32).astype(np.float64), np.frombuffer(row["counts"], np.int64)
            held = sums.setdefault(row["shard"], [0.0, 0, 0])
            held[0], held[1], held[2] = held[0] + z, held[1] + counts, held[2] + row["passages"]
    for shard, (z, counts, passages) in sums.items():
        yield pa.record_batch(
            [[shard], [z.astype(np.float32).tobytes()], [counts.tobytes()], [passages]],
            schema=pa.schema([("shard", pa.int32()), ("z", pa.binary()), ("counts", pa.binary()), ("passages", pa.int64())]),
        )


_SUMS = "shard int, z binary, counts binary, passages long"


@dataclass
class Space:
    """What takes term counts to scaled latent coordinates (at most ``RANK`` by ``TERMS``), and the terms' weights."""

    matrix: np.ndarray
    weights: np.ndarray


def latent_space(texts: DataFrame) -> Space | None:
    sums = texts.select("text").mapInArrow(_sketch, _SUMS).repartition("shard").mapInArrow(_added, _SUMS).collect()
    if not sums:
        return None
    z, counts, passages = np.zeros((RANK, TERMS)), np.zeros(TERMS, np.int64), 0
    width = TERMS // SHARDS
    for row in sums:  # one row per shard
        part = slice(row["shard"] * width, (row["shard"] + 1) * width)
        z[:, part] += np.frombuffer(row["z"], np.float32).reshape(RANK, width)
        counts[part] += np.frombuffer(row["counts"], np.int64)
        passages = max(passages, row["passages"])
    weights = np.maximum(np.log((passages + 1) / (counts + 1)), 0.01)
    inner = _random().astype(np.float64) @ z.T
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    kept = values > max(values.max(), 0) * 1e-9
    if not kept.any():
        return None
    root = (z * weights).T @ (vectors[:, kept] / np.sqrt(values[kept]))
    basis, singular, _ = np.linalg.svd(root, full_matrices=False)
    good = singular > singular[0] * 1e-6
    return Space(((basis[:, good] / singular[good]) * weights[:, None]).T.astype(np.float32), weights.astype(np.float32))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=0)), 1e-12)


@dataclass
class Items:
    """A slice of the benchmark: words and answer words of each item, and its windows' coordinates."""

    ids: list
    words: list[np.ndarray]
    vocabulary: np.ndarray
    holds: np.ndarray  # by item and word of the vocabulary
    answers: list[np.ndarray]  # words of the vocabulary
    asked: np.ndarray  # number of answer words of each item
    by_word: np.ndarray  # items whose answer a word is, word after word of the vocabulary
    ends: np.ndarray  # of each word's items there
    windows: np.ndarray  # by coordinate and window
    owner: np.ndarray  # item of each window
    pivots: np.ndarray  # item and offset in it of each pivot, word after word of the vocabulary
    pivot_ends: np.ndarray  # of each word's pivots there
    runs: list[tuple[int, bytes]]  # items in scripts without blanks, in lower case

    @classmethod
    def of(cls, rows: list, space: Space) -> Items | None:
        texts = pa.array([r[1] for r in rows], pa.large_string())
        with np.errstate(over="ignore"):
            passages = Passages.of(*text_bytes(texts))
        ids, words, windows, owner, runs = [], [], [], [], []
        coordinates = _projected(passages.terms, space.matrix)
        for i, row in enumerate(rows):
            own = passages.words[passages.before[i] : passages.before[i + 1]]
            if not len(own):
                continue
            a, b = passages.first[i], passages.first[i + 1]
            for k in range(a, max(a + 1, b - 1)):
                windows.append(coordinates[:, k : min(k + 2, b)].sum(axis=1))
                owner.append(len(ids))
            if UNPARTED.search(row[1]):
                runs.append((len(ids), LOWER[np.frombuffer(row[1].strip().encode("utf-8", "replace"), np.uint8)].tobytes()))
            ids.append(row[0])
            words.append(own)
        if not ids:
            return None
        vocabulary = np.unique(np.concatenate(words))
        holds = np.zeros((len(ids), len(vocabulary) + 1), bool)
        places = [np.searchsorted(vocabulary, w) for w in words]
        answers = []
        for i, place in enumerate(places):
            holds[i, place] = True
            distinct = np.unique(place)
            rare = space.weights[(vocabulary[distinct] >> _U(44)).astype(np.int64) & (TERMS - 1)]
            answers.append(distinct[np.argsort(-rare, kind="stable")[: max(3, len(distinct) // 6)]])
        word = np.concatenate(answers)
        item = np.repeat(np.arange(len(ids)), [len(a) for a in answers])
        ends = np.cumsum(np.bincount(word, minlength=len(vocabulary) + 1))
        asked = np.array([len(a) for a in answers])
        by_word = item[np.argsort(word, kind="stable")]
        pivots = []
        for i, (place, rarest) in enumerate(zip(places, answers)):
            spare = len(rarest) - int(np.ceil(ANSWERS * len(rarest))) if len(place) >= LEAST_WORDS else 0
            at = np.flatnonzero(np.isin(place, rarest[: spare + 1]))
            pivots.append(np.stack([place[at], np.full(len(at), i), at], axis=1))
        pivots = np.concatenate(pivots)
        pivots = pivots[np.argsort(pivots[:, 0], kind="stable")]
        pivot_ends = np.cumsum(np.bincount(pivots[:, 0], minlength=len(vocabulary) + 1))
        return cls(
            ids, places, vocabulary, holds, answers, asked, by_word, ends, _unit(np.array(windows).T), np.array(owner),
            pivots[:, 1:], pivot_ends, runs,
        )

    def asking(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item and position of every answer word in a run of words."""
        which, where = _entries(place, self.ends)
        return self.by_word[which], where

    def begins(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, position, and where the item would begin, of every pivot in a run of words."""
        which, where = _entries(place, self.pivot_ends)
        return self.pivots[which, 0], where, where - self.pivots[which, 1]


def _entries(place: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All entries of the words of a run, and the position of each."""
    begins = ends - np.diff(ends, prepend=0)
    counts = (ends - begins)[place]
    where = np.repeat(np.arange(len(place)), counts)
    step = np.arange(len(where)) - np.repeat(np.cumsum(counts) - counts, counts)
    return begins[place][where] + step, where


def common_subsequence(item: np.ndarray, near: list[int]) -> int:
    """Length of the longest common subsequence, with a bit per word of the item."""
    masks: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for word in near:
        if mask := masks.get(word):
            met = row & mask
            row = (row + met | row - met) & full
    return len(item) - row.bit_count()


def _matches(passages: Passages, items: Items, space: Space, cosine: float, covered: float) -> dict[tuple[int, int], tuple[int, float]]:
    """For each pair of text and item that passes: common words in order, and the cosine."""
    coordinates = _projected(passages.terms, space.matrix)
    joined = coordinates.copy()
    together = passages.text[1:] == passages.text[:-1]
    joined[:, :-1][:, together] += coordinates[:, 1:][:, together]
    joined = _unit(joined).T
    place = np.searchsorted(items.vocabulary, passages.words)
    place[items.vocabulary[np.minimum(place, len(items.vocabulary) - 1)] != passages.words] = len(items.vocabulary)
    place = np.minimum(place, len(items.vocabulary))
    sizes = np.array([len(w) for w in items.words])
    # Where answer words stand, as one sorted array of item and position.
    stretch = len(place) + 1
    which, where = items.asking(place)
    asked = np.sort(which * stretch + where)
    found: dict[tuple[int, int], tuple[int, float]] = {}

    def check(item: np.ndarray, text: np.ndarray, value: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Adds the pairs whose words from ``low`` to ``high`` hold enough of the item."""
        answered = np.searchsorted(asked, item * stretch + high) - np.searchsorted(asked, item * stretch + low)
        likely = np.flatnonzero(answered >= ANSWERS * items.asked[item])
        item, text, value, low, high = item[likely], text[likely], value[likely], low[likely], high[likely]
        for part in range(0, len(item), 8192):
            s = slice(part, part + 8192)
            span = np.arange(max(1, int((high[s] - low[s]).max())))
            reach = low[s, None] + span
            inside = reach < high[s, None]
            shared = (items.holds[item[s, None], place[np.minimum(reach, len(place) - 1)]] & inside).sum(axis=1)
            for k in (np.flatnonzero(shared >= covered * sizes[item[s]]) + part).tolist():
                pair = (int(text[k]), int(item[k]))
                near = place[low[k] : high[k]]
                own = items.words[pair[1]]
                length = common_subsequence(own, near.tolist())
                answers = items.answers[pair[1]]
                if length >= covered * len(own) and np.isin(answers, near).sum() >= ANSWERS * len(answers):
                    found[pair] = max(found.get(pair, (0, 0.0)), (length, float(value[k])))

    for begin in range(0, len(joined), 4096):
        scores = joined[begin : begin + 4096] @ items.windows
        at, window = np.nonzero(scores >= cosine)
        long = sizes[items.owner[window]] >= LEAST_WORDS
        at, window = at[long], window[long]
        value = scores[at, window]
        item, passage = items.owner[window], at + begin
        text = passages.text[passage]
        # Words of the text from one item's length before the window to one behind it.
        middle = passages.before[text] + (passage - passages.first[text]) * SEGMENT
        low = np.maximum(passages.before[text], middle - sizes[item])
        high = np.minimum(passages.before[text + 1], middle + 2 * SEGMENT + sizes[item])
        check(item, text, value, low, high)

    def likeness(text: int, item: int, position: int) -> float:
        passage = int(passages.first[text]) + (position - int(passages.before[text])) // SEGMENT
        return float((joined[passage] @ items.windows[:, items.owner == item]).max())

    item, where, start = items.begins(place)
    text = np.searchsorted(passages.before, where, "right") - 1
    first, last = passages.before[text], passages.before[text + 1]
    long = sizes[item] >= LEAST_WORDS
    slack = np.maximum(2, sizes[item] // 4)
    low, high = np.maximum(first, start - slack), np.minimum(last, start + sizes[item] + slack)
    already = set(found)
    check(item[long], text[long], np.zeros(int(long.sum())), low[long], high[long])
    for pair in found.keys() - already:
        begun = int(low[long][np.flatnonzero((text[long] == pair[0]) & (item[long] == pair[1]))[0]])
        found[pair] = (found[pair][0], likeness(*pair, begun))
    short = np.flatnonzero(~long & (start >= first) & (start + sizes[item] <= last))
    own = np.full((len(sizes), LEAST_WORDS), -1)
    for i in np.flatnonzero(sizes < LEAST_WORDS).tolist():
        own[i, : sizes[i]] = items.words[i]
    for k in range(LEAST_WORDS):
        wanted = own[item[short], k]
        short = short[(wanted < 0) | (place[np.minimum(start[short] + k, len(place) - 1)] == wanted)]
    for k in short.tolist():
        pair = (int(text[k]), int(item[k]))
        if pair not in found:
            found[pair] = (int(sizes[pair[1]]), likeness(*pair, int(start[k])))
    return found


_FOUND = "doc_id long, matches array<struct<item: long, words: int, cosine: double>>"


def _held(batches: Iterator[pa.RecordBatch], blocks: list[Items], space: Space, cosine: float, covered: float):
    """Runs of rows, each with the matches of its rows."""
    for part, data, offsets in texts_in_chunks(batches, "text"):
        passages = Passages.of(data, offsets)
        rows: list[list[dict]] = [[] for _ in range(len(part))]
        if len(passages.terms):
            lower = LOWER[data].tobytes() if any(items.runs for items in blocks) else b""
            for items in blocks:
                matches = _matches(passages, items, space, cosine, covered)
                for item, run in items.runs:
                    at = lower.find(run)
                    while at >= 0:
                        text = int(np.searchsorted(offsets, at, "right")) - 1
                        if at + len(run) <= offsets[text + 1]:
                            matches.setdefault((text, item), (len(items.words[item]), 1.0))
                            at = lower.find(run, int(offsets[text + 1]))
                        else:
                            at = lower.find(run, at + 1)
                for (text, item), (words, value) in sorted(matches.items()):
                    rows[text].append({"item": items.ids[item], "words": words, "cosine": value})
        yield part, rows


def _search(batches: Iterator[pa.RecordBatch], *how) -> Iterator[pa.RecordBatch]:
    match = pa.struct([("item", pa.int64()), ("words", pa.int32()), ("cosine", pa.float64())])
    for part, rows in _held(batches, *how):
        yield pa.record_batch([part.column("doc_id"), pa.array(rows, pa.list_(match))], names=["doc_id", "matches"])


def _clean(batches: Iterator[pa.RecordBatch], *how) -> Iterator[pa.RecordBatch]:
    for part, rows in _held(batches, *how):
        yield part.filter(pa.array([not r for r in rows], pa.bool_()))


def _slices(texts: DataFrame, benchmark: DataFrame) -> tuple[Space | None, Iterator[list[Items]]]:
    """The latent space of texts and items, and the items in slices of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("length(text) > 0")
    space = latent_space(texts.select("text").unionByName(items.select("text")))
    n = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BYTES)

    def each() -> Iterator[list[Items]]:
        for i in range(n):
            own = items.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == i).orderBy("item_id", "text").collect()
            blocks = [Items.of([(r["item_id"], r["text"]) for r in own[a : a + 256]], space) for a in range(0, len(own), 256)]
            yield [b for b in blocks if b]

    return space, each()


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    cosine: float = COSINE,
    covered: float = COVERED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, matches`` for each row: the items it holds, words in order and cosine.

    Where the items fill several slices, a row comes once per slice.
    """
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    space, slices = _slices(texts, benchmark)
    found = None
    for blocks in slices:
        one = texts.mapInArrow(lambda it, blocks=blocks: _search(it, blocks, space, cosine, covered), _FOUND)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return texts.select("doc_id", F.array().cast("array<struct<item: long, words: int, cosine: double>>").alias("matches"))
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, covered: float = COVERED) -> DataFrame:
    """The rows with all their columns whose ``text`` holds no item."""
    space, slices = _slices(docs, benchmark)
    for blocks in slices:
        docs = docs.mapInArrow(lambda it, blocks=blocks: _clean(it, blocks, space, cosine, covered), docs.schema)
    return docs
