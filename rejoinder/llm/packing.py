"""Packing documents into training sequences by order-preserving dynamic programming.

Documents are laid end to end in the order of their ids, a range of ids per task. A
sequence is a window of that stream. Windows may end where a document ends (free), where
a sentence ends, or, only inside long stretches without either, after any
``HARD_STEP`` tokens; the latter two cost a penalty for cutting a document. The
cheapest set of windows is the shortest path over these places:

    f(j) = penalty(j) + min over i of f(i) + padding(position(j) - position(i))

Padding is linear in the window's length, so the minimum over all starts within reach is
the head of a monotone queue on f(i) + position(i). A window whose length is a power of
two needs no padding; such starts are looked up by their position.

A task works through its range in stretches of about a million tokens and carries the
unfinished windows on, so its memory does not grow with the range. Each range ends with
one window that may be short.

A null or empty text is the end token alone. Repeated rows and ids are packed row by row;
null ids come first. A text longer than a sequence is cut into several pieces.
"""

from __future__ import annotations

import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from rejoinder.llm.frames import chunks
from rejoinder.llm.token_counts import tokenizer

SENTENCE_PENALTY = 4
HARD_PENALTY = 64
HARD_STEP = 256
STRETCH = 1 << 20
LEAST_POWER = 256
CACHE_WORDS = 600_000
LEARN_BYTES = 4 << 20
MARKS = ".,!?;:"
SENTENCE_ENDS = (".", "!", "?")
# Letters in composed form with a lower case of one letter.
LATIN = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}]+$"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def gathered(source: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``source`` one behind the other."""
    before = np.cumsum(sizes) - sizes
    return source[np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)]


class Words:
    """Ids of the words of texts; what was tokenized once is looked up until a cache is full.

    Words are parted at ASCII white space, which the tokenizer drops and never joins
    across. A word of Latin letters with marks behind it is two pre-tokens, so the letters
    are looked up in lower case and without the marks.
    """

    def __init__(self, path: str):
        self.whole = tokenizer(path)
        self.letters, self.last = _letters_only(path)
        self.known: dict[str, bytes] = {}

    def _each(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _spelt(self, bodies: list[str]) -> list[bytes]:
        """All bodies in one call; a word's last id tells where it ends."""
        if not bodies:
            return []
        ids = np.array(self.letters.encode_batch_fast([" ".join(bodies)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
        if len(ends) != len(bodies):
            return self._each(bodies)
        data = ids.tobytes()
        return [data[x:y] for x, y in zip([0, *ends], ends)]

    def _looked_up(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts of words one behind the other, where each begins, and how many it has."""
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        new = pa.array([p for p in parts if p not in known], pa.string())
        latin = pc.match_substring_regex(new, LATIN)
        for chosen, encode in ((latin, self._spelt), (pc.invert(latin), self._each)):
            texts = pc.filter(new, chosen).to_pylist()
            known.update(zip(texts, encode(texts)))
        found = list(map(known.__getitem__, parts))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes, sizes

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one behind the other, and how many each has."""
        trimmed = pc.utf8_rtrim(words, characters=MARKS)
        latin = pc.match_substring_regex(trimmed, LATIN)
        bodies = pc.if_else(latin, pc.utf8_lower(trimmed), words).dictionary_encode()
        marked = pc.subtract(pc.binary_length(words), pc.binary_length(trimmed)).to_numpy() * latin.to_numpy(zero_copy_only=False)
        texts = pc.filter(words, pa.array(marked > 0)).to_pylist()
        marks = np.full(len(words), "", object)
        marks[marked > 0] = [t[-n:] for t, n in zip(texts, marked[marked > 0].tolist())]
        tails = pa.array(marks, pa.string()).dictionary_encode()
        ids, starts, sizes = self._looked_up(bodies.dictionary.to_pylist())
        more, more_starts, more_sizes = self._looked_up(tails.dictionary.to_pylist())
        body, tail = bodies.indices.to_numpy(), tails.indices.to_numpy()
        both = np.stack([sizes[body], more_sizes[tail]], axis=1)
        begin = np.stack([starts[body], len(ids) + more_starts[tail]], axis=1)
        return gathered(np.concatenate([ids, more]), begin.ravel(), both.ravel()), both.sum(axis=1)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts, each with ``end_id`` behind it, where each text ends, and
        where sentences end within."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        source, sizes = self._distinct(coded.dictionary)
        ended = [pc.ends_with(coded.dictionary, pattern=p).to_numpy(zero_copy_only=False) for p in SENTENCE_ENDS]
        sentence = np.logical_or.reduce(ended)
        own = sizes[which]
        after = np.cumsum(own)  # ids up to the end of each word
        before = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        upto = np.concatenate([[0], after])[before]  # ids before each text
        number = np.repeat(np.arange(len(texts)), np.diff(before))
        ends = upto[1:] + np.arange(1, len(texts) + 1)
        ids = np.insert(gathered(source, (np.cumsum(sizes) - sizes)[which], own), upto[1:], end_id).astype("<u4")
        return ids, ends, (after + number)[sentence[which]]


@lru_cache(maxsize=1)
def _words(path: str) -> Words:
    """One per Python worker, so that what one task has looked up serves the next."""
    return Words(path)


@lru_cache(maxsize=2)
def _letters_only(path: str):
    """The same merges for words of letters between blanks, and which ids end a word."""
    from tokenizers import Tokenizer, pre_tokenizers

    plain = Tokenizer(tokenizer(path).model)
    plain.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    suffix = plain.model.end_of_word_suffix or "\0"
    last = np.zeros(max(plain.get_vocab().values()) + 1, bool)
    last[[i for token, i in plain.get_vocab().items() if token.endswith(suffix)]] = True
    return plain, last


def candidate_cuts(sentences: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a run of documents that end at ``ends`` may be cut, and the penalty of each place."""
    places = np.union1d(sentences[(sentences > 0) & (sentences < (ends[-1] if len(ends) else 0))], ends)
    gaps = np.diff(places, prepend=0)
    hard = [np.arange(b - g + HARD_STEP, b, HARD_STEP) for b, g in zip(places[gaps > HARD_STEP], gaps[gaps > HARD_STEP])]
    cuts = np.concatenate([places, *hard])
    cost = np.concatenate([np.full(len(places), SENTENCE_PENALTY), np.full(len(cuts) - len(places), HARD_PENALTY)])
    cost[np.searchsorted(places, ends)] = 0
    order = np.argsort(cuts, kind="stable")
    return cuts[order], cost[order]


def shortest_path(positions: np.ndarray, penalties: np.ndarray, capacity: int) -> list[int]:
    """The window ends of least cost, from ``positions[0]`` to ``positions[-1]``.

    Positions rise by at most ``capacity`` from one to the next.
    """
    size = len(positions)
    place = positions.tolist()
    penalty = penalties.tolist()
    powers = []
    power = LEAST_POWER
    while power < capacity:
        powers.append(power)
        power *= 2
    starts: dict[int, list[int]] = {}
    for power in powers:
        at = np.searchsorted(positions, positions - power)
        for j in np.flatnonzero(positions[np.minimum(at, size - 1)] == positions - power).tolist():
            starts.setdefault(j, []).append(int(at[j]))
    cost, came = [0] * size, [0] * size
    queue: deque[tuple[int, int]] = deque([(place[0], 0)])
    for j in range(1, size):
        here = place[j]
        while place[queue[0][1]] < here - capacity:
            queue.popleft()
        best, i = queue[0]
        best += capacity - here
        for k in starts.get(j, ()):
            if cost[k] < best:
                best, i = cost[k], k
        best += penalty[j]
        cost[j], came[j] = best, i
        key = best + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    path, j = [], size - 1
    while j:
        path.append(place[j])
        j = came[j]
    return path[::-1]


class _Stream:
    """Documents laid end to end, from the first token that no window holds yet."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.sequence = capacity, first_id
        self.begin = self.end = 0
        self.docs: deque[tuple[int | None, int, int, bytes]] = deque()  # id, first position, tokens, ids
        self.cuts: list[np.ndarray] = []
        self.costs: list[np.ndarray] = []

    def add(self, doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray, sentences: np.ndarray) -> None:
        cuts, costs = candidate_cuts(sentences, ends)
        data, first = ids.tobytes(), 0
        for doc_id, last in zip(doc_ids, ends.tolist()):
            self.docs.append((doc_id, self.end + first, last - first, data[4 * first : 4 * last]))
            first = last
        self.cuts.append(cuts + self.end)
        self.costs.append(costs)
        self.end += first

    def pack(self, last: bool) -> list[tuple]:
        """Pieces of the windows that are settled; unless ``last``, the last few stay open."""
        places = np.concatenate([[self.begin], *self.cuts])
        costs = np.concatenate([[0], *self.costs])
        ends = shortest_path(places, costs, self.capacity)
        keep = len(ends) if last else max(0, len(ends) - 4)
        pieces: list[tuple] = []
        for end in ends[:keep]:
            while self.docs and self.docs[0][1] < end:
                doc_id, first, n, ids = self.docs[0]
                a, b = max(self.begin, first), min(end, first + n)
                crc = zlib.crc32(memoryview(ids)[4 * (a - first) : 4 * (b - first)])
                pieces.append((doc_id, a - first, b - a, crc, n, self.sequence, a - self.begin))
                if first + n > end:
                    break
                self.docs.popleft()
            self.begin = end
            self.sequence += 1
        left = places > self.begin
        self.cuts, self.costs = [places[left]], [costs[left]]
        return pieces


def _pack(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, stretch: int) -> Iterator[pa.RecordBatch]:
    words = _words(path)
    stream = _Stream(capacity, TaskContext.get().partitionId() << 40)
    names = [part.split()[0] for part in PIECES.split(", ")]

    def rows(pieces: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*pieces)], names=names)

    for batch in batches:
        for part in chunks(batch, "text", min(LEARN_BYTES, 4 * stretch)):
            stream.add(part.column("doc_id").to_pylist(), *words.encode(part.column("text"), end_id))
            if stream.end - stream.begin >= stretch:
                if pieces := stream.pack(last=False):
                    yield rows(pieces)
    if stream.end > stream.begin:
        yield rows(stream.pack(last=True))


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = 4096,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    stretch: int = STRETCH,
) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence.

    ``path`` names a file of the tokenizers library whose tokens never reach across white
    space. Texts are tokenized whole, without added tokens, and end with ``end_id``.
    """
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(lambda it: _pack(it, path, capacity, end_id, stretch), PIECES)
