"""Removal of byte strings that occur elsewhere, by winnowing and a two-part hash of each window.

Two fixed rounds stand in for bucket-pointer refinement with recursive reuse.

A byte goes if a string of ``LENGTH`` bytes around it also starts anywhere else, in the
same document or another. Positions are sorted into buckets of equal strings, first of
``GRAM`` bytes, then of ``LENGTH``: the longer string at a position is named by the
buckets of the shorter ones at that position and at a later offset, so nothing is read
twice. A position alone in its bucket is settled and takes no part in the next round.

What is refined recursively is which positions are still open:

1. Of each window of ``LENGTH`` bytes, one position decides: the one whose GRAM-bytes
   string has the least hash. Equal windows have it at the same place, so these positions
   (about one in a hundred) stand for all windows. They are sorted into buckets; windows
   whose position is alone in its bucket occur nowhere else.
2. The remaining windows are sorted into buckets of whole strings, named by the buckets
   of their first and their last GRAM bytes. Windows in a bucket of two or more cover
   what is removed.

Buckets are told apart by 64-bit hashes. The sorting is distributed by ranges of the hash:
texts lie in blocks of about ``BLOCK_BYTES``, a block sends every range its distinct hashes
as one packed array, a task sorts all arrays of a range, and one bit per hash goes back.
However often a string occurs, a block sends it once, so no range is hot. The number of
ranges grows with the bytes, so that a task's share does not. Two different strings
have the same hash with probability 2**-64 per pair compared.

Null texts are empty; texts shorter than ``LENGTH`` stay whole. Repeated rows are separate
places, so equal long texts go entirely. Null ids stay; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.frames import chunks, saved, text_bytes
from rejoinder.llm.hashing import mix, prefix_sums

LENGTH = 400
BLOCK_BYTES = 8 << 20
RANGE_BYTES = 32 << 20
LEAST_RANGES = 64
PIECE = 1 << 19
_U = np.uint64
_POSITION = _U((1 << 24) - 1)

_BLOCKS = "block long, ids array<long>, offsets binary, data binary, hashes array<binary>"
_SENT = "block long, part int, hashes binary"
_ANSWER = "block long, part int, stage int, bits binary"


def pieces(offsets: np.ndarray, length: int, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray]]:
    """Stretches of a block that hold every window once, with the text ends inside.

    A long text is cut into stretches that overlap by one byte less than a window.
    """
    begin, ends = 0, []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a < length:
            if begin < a:
                yield begin, a, np.array(ends)
            begin, ends = b, []
            continue
        if b - begin > limit and begin < a:
            yield begin, a, np.array(ends)
            begin, ends = a, []
        while b - begin > limit + length:
            yield begin, begin + limit + length - 1, np.zeros(0, np.int64)
            begin += limit
        ends.append(b)
    if begin < offsets[-1]:
        yield begin, int(offsets[-1]), np.array(ends)


class Windows:
    """The windows of a stretch: GRAM hashes, deciding positions and which windows lie in one text."""

    def __init__(self, data: np.ndarray, begin: int, end: int, ends: np.ndarray, length: int):
        self.begin, self.length, self.gram = begin, length, length // 2 + 1
        width = length - self.gram + 1
        own = data[begin:end]
        sums, down = prefix_sums(own)
        n = len(own) - self.gram + 1
        self.hashes = mix((sums[self.gram :] - sums[: n]) * down[:n])
        # The least hash in reach of each window, by minima from both ends of runs of one width.
        ranked = (self.hashes & ~_POSITION) | np.arange(n, dtype=np.uint64)
        runs = np.concatenate([ranked, np.full(-n % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
        ahead = np.minimum.accumulate(runs, axis=1).ravel()
        behind = np.minimum.accumulate(runs[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(own) - length + 1
        self.deciding = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & _POSITION).astype(np.int64)
        self.inside = np.ones(count, bool)
        for e in (ends - begin).tolist():
            self.inside[max(0, e - length + 1) : e] = False

    def positions(self) -> np.ndarray:
        return np.unique(self.deciding[self.inside])

    def names(self, at: np.ndarray) -> np.ndarray:
        """Of the windows that start ``at``, named by the buckets of their first and last GRAM bytes."""
        return mix(self.hashes[at] * _U(0x9FB21C651E98DF25) + self.hashes[at + self.length - self.gram])


def _windows(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[Windows]:
    with np.errstate(over="ignore"):
        for begin, end, ends in pieces(offsets, length):
            yield Windows(data, begin, end, ends, length)


def first_round(data: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the GRAM-bytes strings at all deciding positions, in order of position."""
    found = [w.hashes[w.positions()] for w in _windows(data, offsets, length)]
    return np.concatenate([*found, np.zeros(0, np.uint64)])


def second_round(data: np.ndarray, offsets: np.ndarray, length: int, open_hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and names of the windows whose deciding position is not alone; ``open_hashes`` are sorted."""
    for w in _windows(data, offsets, length):
        positions = w.positions()
        wanted = np.zeros(len(w.hashes), bool)
        wanted[positions] = _among(w.hashes[positions], open_hashes)
        at = np.flatnonzero(w.inside & wanted[w.deciding])
        if len(at):
            yield at + w.begin, w.names(at)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and whether each comes more than once; ``hashes`` are sorted in place.

    A block that repeats throughout has a hash for every byte: little is held beside them.
    """
    hashes.sort()
    first = np.ones(len(hashes) + 1, bool)
    np.not_equal(hashes[1:], hashes[:-1], out=first[1:-1])
    return hashes[first[:-1]], ~first[1:][first[:-1]]


def _by_range(known: np.ndarray, ranges: int) -> list[int]:
    """Where the sorted hashes of each range begin, and their number."""
    # The first hash of range p is the least h with (h >> 32) * ranges >> 32 == p.
    least = [-(-(p << 32) // ranges) << 32 for p in range(1, ranges)]
    return [0, *np.searchsorted(known, np.array(least, np.uint64)).tolist(), len(known)]


def _ranges(hashes: np.ndarray, ranges: int) -> list[bytes]:
    """Distinct hashes by range, packed, and whether each comes more than once in the block."""
    known, often = _distinct(hashes)
    ends = _by_range(known, ranges)
    return [_packed(known[a:b], often[a:b]) if b > a else b"" for a, b in zip(ends, ends[1:])]


def _packed(known: np.ndarray, often: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte plane by byte plane: the upper planes are nearly empty."""
    steps = np.diff(known, prepend=_U(0)).astype("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes() + np.packbits(often).tobytes())


def _received(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = len(data) * 8 // 65
    steps = np.ascontiguousarray(data[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64), np.unpackbits(data[8 * n :], count=n).astype(bool)


def _block_rows(batches: Iterator[pa.RecordBatch], length: int, ranges: int) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    packer = zstandard.ZstdCompressor(level=6)
    names = [part.split()[0] for part in _BLOCKS.split(", ")]
    held: list[pa.RecordBatch] = []
    size = 0

    def row() -> pa.RecordBatch:
        texts = pa.chunked_array([h.column(1).cast(pa.large_binary()) for h in held]).combine_chunks()
        data, offsets = text_bytes(texts)
        ids = [key for h in held for key in h.column(0).to_pylist()]
        sent = _ranges(first_round(data, offsets, length), ranges)
        values = [[block], [ids], [offsets.tobytes()], [packer.compress(data.tobytes())], [sent]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.binary())]
        return pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

    for batch in batches:
        for part in chunks(batch, "text", BLOCK_BYTES // 8):
            held.append(part)
            size += sum(len(t) for t in part.column(1).cast(pa.large_binary()).to_pylist() if t)
            if size >= BLOCK_BYTES:
                yield row()
                block, held, size = block + 1, [], 0
    if held:
        yield row()


def _sort_range(table: pa.Table) -> pa.Table:
    """For all blocks' hashes of one range, whether each occurs in more than one place."""
    received = [_received(b) for b in table.column("hashes").to_pylist()]
    merged = np.sort(np.concatenate([h for h, _ in received]))
    several = merged[1:][merged[1:] == merged[:-1]]
    bits = [np.packbits(often | _among(h, several)).tobytes() for h, often in received]
    return pa.table({"block": table.column("block"), "part": table.column("part"), "bits": pa.array(bits, pa.binary())})


def _sorted(sent: DataFrame, stage: int) -> DataFrame:
    found = sent.groupBy("part").applyInArrow(_sort_range, "block long, part int, bits binary")
    return found.select("block", "part", F.lit(stage).alias("stage"), "bits")


class _Block:
    """A block's texts and what has come back for it."""

    def __init__(self, blocks: pa.Table, answers: pa.Table):
        row = blocks.slice(0, 1).to_pylist()[0]
        self.number, self.ids = row["block"], row["ids"]
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"], max(1, int(self.offsets[-1]))), np.uint8)
        self.answers = {(a["stage"], a["part"]): a["bits"] for a in answers.to_pylist()}

    def several(self, hashes: np.ndarray, stage: int, ranges: int) -> np.ndarray:
        """Of the hashes sent, sorted, those that occur in more than one place."""
        known, _ = _distinct(hashes)
        ends = _by_range(known, ranges)
        bits = np.zeros(len(known), bool)
        for part, (a, b) in enumerate(zip(ends, ends[1:])):
            if b > a:
                bits[a:b] = np.unpackbits(np.frombuffer(self.answers[stage, part], np.uint8), count=b - a)
        return known[bits]


def _send_windows(blocks: pa.Table, answers: pa.Table, length: int, ranges: int) -> pa.Table:
    block = _Block(blocks, answers)
    still = block.several(first_round(block.data, block.offsets, length), 1, ranges)
    names = [n for _, n in second_round(block.data, block.offsets, length, still)]
    sent = [(part, blob) for part, blob in enumerate(_ranges(np.concatenate([*names, np.zeros(0, np.uint64)]), ranges)) if blob]
    return pa.table(
        {
            "block": pa.array([block.number] * len(sent), pa.int64()),
            "part": pa.array([p for p, _ in sent], pa.int32()),
            "hashes": pa.array([b for _, b in sent], pa.binary()),
        }
    )


def _cut(blocks: pa.Table, answers: pa.Table, length: int, ranges: int) -> pa.Table:
    block = _Block(blocks, answers)
    still = block.several(first_round(block.data, block.offsets, length), 1, ranges)
    opened = list(second_round(block.data, block.offsets, length, still))
    twice = block.several(np.concatenate([*(n for _, n in opened), np.zeros(0, np.uint64)]), 2, ranges)
    change = np.zeros(len(block.data) + 1, np.int32)
    while opened:
        at, names = opened.pop()
        at = at[_among(names, twice)]
        change[at] += 1
        change[at + length] -= 1  # windows start at different places
    removed = np.cumsum(change, out=change)[:-1] > 0
    rows = []
    for key, a, b in zip(block.ids, block.offsets[:-1].tolist(), block.offsets[1:].tolist()):
        own = np.concatenate([[False], removed[a:b], [False]])
        edges = np.flatnonzero(own[1:] != own[:-1])
        spans = [{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)]
        kept = block.data[a:b][~removed[a:b]].tobytes() if spans else block.data[a:b].tobytes()
        rows.append((key, b - a, spans, kept))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())]
    return pa.table({name: pa.array(c, k) for (name, k), c in zip(kinds, zip(*rows))})


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes``, the removed ``spans`` (bytes, end exclusive) and the ``kept`` bytes of each row."""
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(LEAST_RANGES, -(-total // RANGE_BYTES))
    # Many small partitions would make as many small blocks, each with hashes for every range.
    fewest = max(3 * docs.sparkSession.sparkContext.defaultParallelism, -(-total // (2 * BLOCK_BYTES)))
    blocks = saved(texts.coalesce(fewest).mapInArrow(lambda it: _block_rows(it, length, ranges), _BLOCKS), "repeat-blocks")
    sent = blocks.select("block", F.posexplode("hashes").alias("part", "hashes")).filter(F.length("hashes") > 0)
    first = saved(_sorted(sent, 1), "repeat-first")
    rows = blocks.drop("hashes")
    windows = (
        rows.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(lambda a, b: _send_windows(a, b, length, ranges), _SENT)
    )
    answers = first.unionByName(saved(_sorted(windows, 2), "repeat-second"))
    schema = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda a, b: _cut(a, b, length, ranges), schema)
