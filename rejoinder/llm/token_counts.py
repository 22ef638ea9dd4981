"""Token counts of whole texts without making their ids.

A text is split into pre-tokens once. Blocks of texts (about 16 MB each) are kept as
frequency vectors over the block's own list of distinct pre-tokens. The list is dealt
into buckets by hash; a bucket's lists of all blocks meet in one task, where each distinct
pre-token is tokenized once. The counts go back to their blocks in the order of the list
and are multiplied with the frequencies.

A frequent pre-token is sent once per block, not once per text, so no key is hot. A task
forgets what it has tokenized after a million pre-tokens, so its memory stays bounded.
A special string inside a text is one token, as the tokenizer takes it by default; what
lies between two of them is split on its own.

Null and empty texts have no tokens. Repeated rows and ids are counted row by row; null
ids stay. Other columns are left out.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.frames import bound_batches, saved

BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 1 << 16
LEAST_BUCKETS = 64
KNOWN_PIECES = 1_000_000
BETWEEN = b"\xff"  # in no UTF-8 text

BLOCK_SCHEMA = (
    "block long, pieces array<binary>, ids array<long>, bytes array<long>, "
    "special array<long>, sizes array<long>, codes binary, times binary"
)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Codes(dict):
    """Numbers keys in the order in which they come."""

    def __missing__(self, key: str) -> int:
        self[key] = code = len(self)
        return code


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers byte plane by byte plane, which leaves long runs of zeros."""
    return zlib.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _dealt(pieces: list[str], buckets: int) -> tuple[list[bytes], np.ndarray]:
    """The pieces of each bucket, compressed, and each piece's place in the order of all buckets."""
    coded = [p.encode() for p in pieces]
    owner = np.fromiter((zlib.crc32(p) % buckets for p in coded), np.int64, len(pieces))
    order = np.argsort(owner, kind="stable")
    place = np.empty(len(pieces), np.int64)
    place[order] = np.arange(len(pieces))
    ends = np.cumsum(np.bincount(owner, minlength=buckets)).tolist()
    named = [coded[i] for i in order.tolist()]
    return [zlib.compress(BETWEEN.join(named[a:b]), 1) if b > a else b"" for a, b in zip([0, *ends], ends)], place


class _Block:
    """Texts of one partition, up to ``BLOCK_BYTES``, as counts of pre-tokens."""

    def __init__(self, number: int):
        self.number = number
        self.codes, self.held = _Codes(), 0
        self.ids, self.bytes, self.special, self.sizes, self.flat, self.times = [], [], [], [], [], []

    def add(self, key: int | None, n_bytes: int, special: int, counts: Counter[str]) -> None:
        self.flat.extend(map(self.codes.__getitem__, counts))
        self.times.extend(counts.values())
        self.ids.append(key)
        self.bytes.append(n_bytes)
        self.special.append(special)
        self.sizes.append(len(counts))
        self.held += n_bytes

    def row(self, buckets: int) -> pa.RecordBatch:
        pieces, place = _dealt(list(self.codes), buckets)
        owner = np.repeat(np.arange(len(self.ids)), self.sizes)
        keys = owner * len(place) + place[np.array(self.flat, np.int64)]
        order = np.argsort(keys)
        values = [
            [self.number], [pieces], [self.ids], [self.bytes], [self.special], [self.sizes],
            [_packed(np.diff(keys[order], prepend=0))], [_packed(np.array(self.times, np.int64)[order])],
        ]
        kinds = [pa.int64(), pa.list_(pa.binary()), *[pa.list_(pa.int64())] * 4, pa.binary(), pa.binary()]
        names = [part.split()[0] for part in BLOCK_SCHEMA.split(", ")]
        return pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds)], names=names)


def _blocks(
    batches: Iterator[pa.RecordBatch], pattern: str, special: tuple[str, ...], buckets: int, block_bytes: int
) -> Iterator[pa.RecordBatch]:
    find = regex.compile(pattern).findall
    breaks = regex.compile("|".join(map(regex.escape, special))) if special else None
    block = _Block(TaskContext.get().partitionId() << 32)
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            parts = breaks.split(text) if breaks else [text]
            counts = Counter(find(parts[0]))
            for part in parts[1:]:
                counts.update(find(part))
            block.add(key, len(text.encode()), len(parts) - 1, counts)
            if block.held >= block_bytes or len(block.ids) >= BLOCK_ROWS:
                yield block.row(buckets)
                block = _Block(block.number + 1)
    if block.ids:
        yield block.row(buckets)


def _count_pieces(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Of each list of pieces their numbers of tokens; a piece is tokenized when first seen."""
    known: dict[bytes, int] = {}
    for batch in batches:
        sizes = []
        for row in batch.column("pieces"):
            pieces = zlib.decompress(row.as_py()).split(BETWEEN)
            if len(known) > KNOWN_PIECES:
                known.clear()
            new = [p for p in pieces if p not in known]
            found = tokenizer(path).encode_batch_fast([p.decode() for p in new], add_special_tokens=False)
            known.update(zip(new, (len(e.ids) for e in found)))
            sizes.append(_packed(np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))))
        yield pa.record_batch(
            [batch.column("block"), batch.column("bucket"), pa.array(sizes, pa.binary())], names=["block", "bucket", "n"]
        )


def _sum_block(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    row = blocks.slice(0, 1).to_pylist()[0]
    dealt = sorted(zip(counts.column("bucket").to_pylist(), counts.column("n").to_pylist()))
    n = np.concatenate([*(_unpacked(data) for _, data in dealt), np.zeros(0, np.int64)])
    ends = np.cumsum([0, *row["sizes"]])
    codes = np.cumsum(_unpacked(row["codes"])) % max(1, len(n))
    total = np.concatenate([[0], np.cumsum(_unpacked(row["times"]) * n[codes])])
    tokens = total[ends[1:]] - total[ends[:-1]] + np.array(row["special"], np.int64)
    return pa.table(
        {"doc_id": pa.array(row["ids"], pa.int64()), "n_bytes": pa.array(row["bytes"], pa.int64()), "n_tokens": tokens}
    )


def count_tokens(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for each row.

    ``path`` names a byte-level BPE file of the tokenizers library whose pre-tokenizer
    splits by the pattern of ``public_tokenizers.PATTERN`` and nothing else.
    """
    import public_tokenizers

    bound_batches(docs.sparkSession)
    special = tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())
    pattern = public_tokenizers.PATTERN
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    buckets = max(LEAST_BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    made = texts.mapInArrow(lambda it: _blocks(it, pattern, special, buckets, block_bytes), BLOCK_SCHEMA)
    blocks = saved(made, "token-blocks")
    pieces = blocks.select("block", F.posexplode("pieces").alias("bucket", "pieces")).filter(F.length("pieces") > 0)
    counts = pieces.repartition("bucket").mapInArrow(lambda it: _count_pieces(it, path), "block long, bucket int, n binary")
    return (
        blocks.drop("pieces")
        .groupBy("block")
        .cogroup(counts.groupBy("block"))
        .applyInArrow(_sum_block, "doc_id long, n_bytes long, n_tokens long")
    )
