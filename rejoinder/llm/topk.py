"""Exact top-k by inner product, pruned block by block.

Vectors are dealt into parts by ranges of their id, a part into groups of ``GROUP`` rows at
most and a group into blocks of ``BLOCK`` rows with the largest and smallest value of every
component. For a query the sum over components of what a block could give at most bounds all
scores of the block. Each query takes the block of its largest bound first, then blocks come
by falling bound; a block is passed over by every query whose k-th best score so far is above
its bound. A tie is scored as long as a smaller id could win it.

Every query meets every part once: queries travel in chunks, one copy per part, and a task
holds one chunk and one group at a time; the k-th best scores go on from group to group. Each
part gives at most k rows per query, and the best k of all parts are taken in the end.
A part has up to ``GROUPS`` groups once there are ``PARTS`` of them: neither the copies of a query
nor the ranges and files that the driver knows of follow the number of groups.

Components are multiplied by ``scale`` and rounded down; scores are integers and must fit
in 64 bits. Vectors that are null or hold null or non-finite components take no part, nor
do rows without an id. Shorter vectors count as ending in zeros. Every row is a candidate
and every row that asks does so, also where rows repeat an id; none is a candidate for a
row of its own id. The results of rows that ask under one id are ranked together, and ties between
rows of one id are equal rows of the result. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rejoinder.llm.frames import bound_batches, saved

BLOCK = 128
GROUP = 4096
CHUNK = 8192
GROUPS = 64
PARTS = 64

_ROW_BYTES = 4 << 20
_TILE = 1024
_PACKED = "part long, number long, ids binary, vectors binary"
_LEAST = np.iinfo(np.int64).min


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _rows(most: int, size: int) -> int:
    """Rows that are packed into one: ``most``, or fewer long vectors."""
    return max(BLOCK, min(most, _ROW_BYTES // (8 * size)))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    values = np.zeros((len(column), size))
    values[np.arange(size) < lengths[:, None]] = flat
    return values


def _pack(batches: Iterator[pa.RecordBatch], size: int, scale: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Ids and integer vectors of a partition, in rows of up to ``rows`` of them, in as few bytes as hold them."""
    part, number = TaskContext.get().partitionId(), 0
    ids, vectors = np.zeros(0, np.int64), np.zeros((0, size), np.int64)

    def row(n: int) -> pa.RecordBatch:
        values = vectors[:n]
        kind = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= values.min() and values.max() <= np.iinfo(t).max)
        return pa.record_batch(
            [[part], [number], [ids[:n].tobytes()], [values.astype(kind).tobytes()]],
            schema=pa.schema([("part", pa.int64()), ("number", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())]),
        )

    for batch in batches:
        ids = np.concatenate([ids, batch.column(0).to_numpy(zero_copy_only=False)])
        vectors = np.concatenate([vectors, np.floor(scale * _matrix(batch.column(1), size)).astype(np.int64)])
        while len(ids) >= rows:
            yield row(rows)
            number, ids, vectors = number + 1, ids[rows:], vectors[rows:]
    if len(ids):
        yield row(len(ids))


def _unpack(ids: pa.Scalar, vectors: pa.Scalar, size: int) -> tuple[np.ndarray, np.ndarray]:
    keys, data = np.frombuffer(ids.as_buffer(), np.int64), vectors.as_buffer()
    return keys, np.frombuffer(data, f"i{data.size // (len(keys) * size)}").reshape(-1, size)


def _most(values: np.ndarray) -> float:
    return max(float(values.max(initial=0)), -float(values.min(initial=0)))


def _places(holds: np.ndarray) -> np.ndarray:
    """Like ``flatnonzero``, but eight places are passed over at a time where few hold."""
    if holds.size % 8:
        return np.flatnonzero(holds)
    eights = np.flatnonzero(holds.reshape(-1).view(np.uint64))
    if 16 * len(eights) > holds.size:
        return np.flatnonzero(holds)
    row, place = np.nonzero(holds.reshape(-1, 8)[eights])
    return 8 * eights[row] + place


class _Best:
    """The best ``k`` rows of each query of a chunk, among the groups it has met."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.ids, self.queries, self.k, self.most, self.kinds = ids, queries, k, _most(queries), {}
        self.count = np.zeros(len(ids), np.int64)
        self.scores, self.found = (np.zeros((len(ids), k), np.int64) for _ in range(2))

    def meet(self, vectors: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> None:
        largest = self.most * _most(vectors) * self.queries.shape[1]
        kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64  # exact, and much faster in floating point
        if kind not in self.kinds:
            queries = self.queries.astype(kind)
            self.kinds[kind] = queries, np.maximum(queries, 0), np.minimum(queries, 0)
        queries, above, below = self.kinds[kind]
        vectors, starts = vectors.astype(kind), np.arange(0, len(ids), block)
        bounds = above @ np.maximum.reduceat(vectors, starts, axis=0).T + below @ np.minimum.reduceat(vectors, starts, axis=0).T
        least = np.minimum.reduceat(ids, starts)
        first = bounds.argmax(axis=1)
        falling = np.argsort(-bounds.max(axis=0), kind="stable")
        for b, asks in [*((b, first == b) for b in np.unique(first)), *((b, first != b) for b in falling)]:
            limit = self._limit(least[b], kind)
            self._score(queries, vectors, ids, slice(starts[b], starts[b] + block), asks & (bounds[:, b] >= limit), limit)

    def _limit(self, least: int, kind: type) -> np.ndarray:
        """The score from which a row with the id ``least`` or a larger one would be among the best."""
        kth = self.scores[:, -1] + (self.found[:, -1] <= least)
        return np.where(self.count == self.k, kth.astype(kind), _LEAST if kind is np.int64 else -np.inf).astype(kind)

    def _score(self, queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: slice, asks: np.ndarray, limit: np.ndarray) -> None:
        """Scores the ``rows`` of a block for those who ask, and takes what reaches the ``limit`` of each query."""
        asking = np.flatnonzero(asks)
        if not len(asking):
            return
        dense = 4 * len(asking) > 3 * len(asks)  # then all are scored, which needs no copy
        if dense:
            asking = np.arange(len(asks))
        near, met = ids[rows], []
        for a in range(0, len(asking), _TILE):
            some = asking[a : a + _TILE]
            scores = (queries[a : a + _TILE] if dense else queries[some]) @ vectors[rows].T
            hits = _places(scores >= limit[some, None])
            if len(near) > self.k and len(hits) > 4 * self.k * len(some):
                kept = np.where(near == self.ids[some, None], _LEAST if scores.dtype == np.int64 else -np.inf, scores)
                kth = np.partition(kept, -self.k, axis=1)[:, -self.k, None]
                hits = _places((scores >= limit[some, None]) & (scores >= kth))
            if len(hits):
                query, place = some[hits // len(near)], hits % len(near)
                own = asks[query] & (near[place] != self.ids[query])
                met.append((query[own], near[place[own]], scores.ravel()[hits[own]].astype(np.int64)))
        if met:
            self._add(*(np.concatenate(x) for x in zip(*met)))

    def _add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        touched, row = np.unique(query, return_inverse=True)
        held = np.flatnonzero(np.arange(self.k) < self.count[touched, None])
        row = np.concatenate([held // self.k, row])
        ids = np.concatenate([self.found[touched].ravel()[held], ids])
        scores = np.concatenate([self.scores[touched].ravel()[held], scores])
        order = np.lexsort((ids, ~scores, row))
        row, ids, scores = row[order], ids[order], scores[order]
        place = np.arange(len(row)) - np.searchsorted(row, np.arange(len(touched)))[row]
        best = place < self.k
        at = touched[row[best]], place[best]
        self.found[at], self.scores[at] = ids[best], scores[best]
        self.count[touched] = np.minimum(np.bincount(row, minlength=len(touched)), self.k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query id, vector id and score, query by query from the best row on."""
        there = np.arange(self.k) < self.count[:, None]
        return np.repeat(self.ids, self.count), self.found[there], self.scores[there]


def best_of_group(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, block: int = BLOCK
) -> Iterator[tuple[int, int, int]]:
    """Query id, vector id and score of each query's best ``k`` rows of a group."""
    best = _Best(query_ids, queries, k)
    best.meet(vectors, ids, block)
    yield from zip(*(column.tolist() for column in best.rows()))


def _search(batches: Iterator[pa.RecordBatch], size: int, k: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a chunk and a group; those of a chunk with the groups of a part come in a run."""
    best, run = None, None

    def rows() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, pa.int64()) for c in best.rows()], names=["query_id", "vec_id", "score"])

    for batch in batches:
        for chunk, query_ids, queries, ids, vectors in zip(zip(*(batch.column(c).to_pylist() for c in range(3))), *batch.columns[3:]):
            if chunk != run:
                if best is not None:
                    yield rows()
                best, run = _Best(*_unpack(query_ids, queries, size), k), chunk
            keys, values = _unpack(ids, vectors, size)
            best.meet(values, keys)
    if best is not None:
        yield rows()


def _parts(n: int, rows: int) -> int:
    """Parts of ``n`` vectors in groups of ``rows``: one per group as long as these are few."""
    return max(1, min(-(-n // rows), max(PARTS, -(-n // (GROUPS * rows)))))


def search(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for every row that ``is_query``."""
    bound_batches(vectors.sparkSession)
    usable = vectors.select(
        vectors[id_column].cast("long").alias("key"), vectors[vector_column].cast("array<double>").alias("vector"), is_query.alias("asks")
    ).filter(F.col("key").isNotNull() & _usable(F.col("vector")))
    found = usable.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asks"), 1)).alias("asking"), F.max(F.size("vector")).alias("size")).first()
    size = max(1, found["size"] or 0)
    group, chunk = _rows(GROUP, size), _rows(CHUNK, size)
    # Rows that repeat an id are told apart by their vectors: no part has them all.
    dealt = usable.select("key", "vector").repartitionByRange(_parts(found["n"], group), "key", F.xxhash64("vector")).sortWithinPartitions("key")
    groups = saved(dealt.mapInArrow(lambda it: _pack(it, size, scale, group), _PACKED), "topk-groups")
    asked = usable.filter("asks").select("key", "vector").repartition(max(1, -(-found["asking"] // chunk)))
    chunks = saved(asked.mapInArrow(lambda it: _pack(it, size, scale, chunk), _PACKED), "topk-chunks")
    last = groups.agg(F.max("part")).first()[0]
    copies = chunks.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last if last is not None else 0).cast("long"))).alias("part"),
        F.col("part").alias("dealt"),
        F.col("number").alias("chunk"),
        F.col("ids").alias("query_ids"),
        F.col("vectors").alias("queries"),
    )
    # Merged and never broadcast: the driver would hold every chunk or group.
    pairs = copies.join(groups.select("part", "ids", "vectors").hint("merge"), "part")
    near = pairs.select("part", "dealt", "chunk", "query_ids", "queries", "ids", "vectors").mapInArrow(
        lambda it: _search(it, size, k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
