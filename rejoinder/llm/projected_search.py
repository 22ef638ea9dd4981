"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

The largest inner products are the least distances once every vector gets one more
component that brings it to the length of the longest, and every query is brought to that length. Normal
random numbers are 2-stable: along ``DIMENSIONS`` such directions, the squared projected
distance of two points is their squared distance times a chi-square variable. So a neighbour
at distance d lies within ``d * sqrt(quantile)`` of the query in projection, with the
probability of that quantile. Neighbours are taken in the projection and verified with
the original vectors until the next one lies beyond that radius for the k-th best distance
found: whatever is still unseen then has less than ``1 - CONFIDENCE`` chance to be among the best.

*Index.* The upper levels of the kd-tree are fitted on a bounded sample of ``SAMPLE``
projected vectors; its leaves are cells, at most ``CELLS`` of them, so that their boxes fit into any task.
Every vector is put into its cell, and a cell is dealt over blocks of about ``BLOCK`` vectors. A block is
one packed row; a task builds the lower levels of the tree over it, down to leaves of ``LEAF`` vectors.

*Search.* Queries are packed by cell into chunks of ``CHUNK``. In a first round each chunk
meets one block of the cells next to its queries, which gives an upper bound of every k-th
distance. In the second, a chunk goes to the blocks of those cells only whose box in the
projection is within the stopping radius of one of its queries. In a block, a query takes
leaves by distance of their box, and verifies those of their vectors that lie within the radius
for the bound it came with or a better one, until the next leaf lies beyond.

Equal vectors are searched once: of those, the ``k + 1`` smallest ids can be among the best of
any query, so only these are kept as candidates, by a limit that works before the shuffle; queries
with equal vectors share their search, and a query's own id is left out after it.

Scores are inner products in double precision, ties go to the smaller id. Vectors that are
null or zero, or hold null or non-finite components, take no part, nor do rows without an id.
Shorter vectors count as ending in zeros. Rows that repeat an id and vector are
candidates as often as they occur and ask once. An id with several vectors asks with each; none of
its rows is a candidate for it, and where more than one of them is among the ``k + 1`` nearest it
gets fewer than ``k``. With fewer candidates than k all are returned, and an empty table gives no
rows. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rejoinder.llm.frames import saved

DIMENSIONS = 16
CONFIDENCE = 0.95
SAMPLE = 50_000
CELLS = 4096
BLOCK = 4096
CHUNK = 256
LEAF = 64
#: Leaves of a block that are verified before the bound is looked at again; twice as many each time.
FIRST_LEAVES = 4
SEED = 20250307

_CANDIDATES = "key binary, score double, id long, copies long"


def chi_square_quantile(dimensions: int, probability: float) -> float:
    """Where the distribution with an even number of degrees of freedom reaches ``probability``."""
    low, high = 0.0, 1.0

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dimensions // 2))

    while below(high) < probability:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < probability else (low, middle)
    return high


# --- projections and cells ---------------------------------------------------


@dataclass(frozen=True)
class Projection:
    """Lifts vectors of ``size`` components onto a sphere of ``radius`` and projects them."""

    size: int
    radius: float
    dimensions: int = DIMENSIONS
    seed: int = SEED

    def _directions(self) -> np.ndarray:
        return np.random.default_rng(self.seed).standard_normal((self.size + 1, self.dimensions))

    def points(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.radius**2 - (vectors * vectors).sum(axis=1)))
        directions = self._directions()
        return vectors @ directions[:-1] + rest[:, None] * directions[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors * self.stretch(vectors)[:, None]) @ self._directions()[:-1]

    def stretch(self, vectors: np.ndarray) -> np.ndarray:
        return self.radius / np.sqrt((vectors * vectors).sum(axis=1))

    def squared_distance(self, scores: np.ndarray, stretch: np.ndarray) -> np.ndarray:
        """Of a lifted query to a lifted vector, from their inner product."""
        return np.maximum(0.0, 2 * self.radius**2 - 2 * stretch * scores)


def fit_cells(points: np.ndarray, cells: int) -> list[tuple[int, float]]:
    """A kd-tree as a heap of splits ``axis, value`` with about ``cells`` leaves; -1 for no axis."""
    levels = max(0, math.ceil(math.log2(max(1, cells))))
    splits: list[tuple[int, float]] = [(-1, 0.0)] * ((1 << levels) - 1)
    parts = {0: points}
    for node in range(len(splits)):
        own = parts.pop(node, points[:0])
        left = right = own[:0]
        if len(own) > 1:
            axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            value = float(np.median(own[:, axis]))
            splits[node] = (axis, value)
            high = own[:, axis] >= value
            left, right = own[~high], own[high]
        parts[2 * node + 1], parts[2 * node + 2] = left, right
    return splits


def cell_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    """The leaf of each point, numbered from 0."""
    node = np.zeros(len(points), np.int64)
    if not splits:
        return node
    axes, values = np.array([s[0] for s in splits]), np.array([s[1] for s in splits])
    for _ in range((len(splits) + 1).bit_length() - 1):
        axis = axes[node]
        high = (axis >= 0) & (points[np.arange(len(points)), np.maximum(axis, 0)] >= values[node])
        node = 2 * node + 1 + high
    return node - len(splits)


def leaves_of(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """The rows of each leaf of a kd-tree over ``points``, split at medians of the widest axis."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            done.append(rows)
            continue
        own = points[rows]
        axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        order = np.argpartition(own[:, axis], len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return done


def box_distances(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each query to each box."""
    found = np.zeros((len(queries), len(low)))
    for axis in range(queries.shape[1]):
        q = queries[:, axis, None]
        apart = np.maximum(0.0, np.maximum(low[None, :, axis] - q, q - high[None, :, axis]))
        found += apart * apart
    return found


# --- the search of one block -------------------------------------------------


class Block:
    """Vectors with their ids and copies, and the leaves of a kd-tree over their projections."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]], copies: list[list[int]], projection: Projection):
        self.vectors, self.ids, self.copies, self.projection = vectors, ids, copies, projection
        self.smallest = np.array([x[0] for x in ids], np.int64)
        self.points = projection.points(vectors)
        self.lengths = (self.points * self.points).sum(axis=1)
        self.leaves = leaves_of(self.points)
        self.low = np.array([self.points[rows].min(axis=0) for rows in self.leaves])
        self.high = np.array([self.points[rows].max(axis=0) for rows in self.leaves])

    def nearest(self, queries: np.ndarray, bounds: np.ndarray, k: int, quantile: float) -> tuple[list[list[tuple[float, int]]], int]:
        """Score and row of the best ``k`` of each query within its bound, and how many vectors were verified."""
        projected, stretch = self.projection.queries(queries), self.projection.stretch(queries)
        boxes = box_distances(projected, self.low, self.high)
        orders = np.argsort(boxes, axis=1)
        apart = (projected * projected).sum(axis=1)[:, None] + self.lengths - 2 * (projected @ self.points.T)
        found, verified = [], 0
        for q, query in enumerate(queries):
            score, row = np.zeros(0), np.zeros(0, np.int64)
            slack = 1e-12 * self.projection.radius * float(np.sqrt(query @ query))
            bound, distances, at, width = float(bounds[q]), boxes[q], 0, FIRST_LEAVES
            while at < len(orders[q]) and distances[orders[q][at]] <= bound * quantile:
                radius = bound * quantile
                near = orders[q][at : at + width]
                at, width = at + width, 2 * width
                rows = np.concatenate([self.leaves[leaf] for leaf in near if distances[leaf] <= radius])
                if radius < math.inf:
                    rows = rows[apart[q, rows] <= radius * (1 + 1e-9)]
                verified += len(rows)
                scores = self.vectors[rows] @ query
                if len(score) == k:  # what rounding could still bring among the best is kept
                    worth = scores >= score[-1] - slack
                    rows, scores = rows[worth], scores[worth]
                elif len(rows) > 4 * k:
                    rows = rows[scores >= np.partition(scores, -k)[-k] - slack]
                # The same sum for equal vectors, wherever they lie; ties go to the smaller id.
                score, row = np.concatenate([score, (self.vectors[rows] * query).sum(axis=1)]), np.concatenate([row, rows])
                best = np.lexsort((self.smallest[row], -score))[:k]
                score, row = score[best], row[best]
                if len(score) == k:
                    bound = min(bound, float(self.projection.squared_distance(score[-1], stretch[q])))
            found.append(list(zip(score.tolist(), row.tolist())))
        return found, verified


# --- over the cluster --------------------------------------------------------


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    values = np.zeros((len(column), size))
    for i, vector in enumerate(column.to_pylist()):
        values[i, : len(vector)] = vector
    return values


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    zero = F.forall(vector, lambda x: x == 0)
    return F.coalesce(vector.isNotNull() & finite & ~zero, F.lit(False))


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of equal length, equal for equal vectors."""
    for batch in batches:
        values = _matrix(batch.column("vector"), size) + 0.0  # no negative zeros
        keys = pa.array([v.tobytes() for v in values], pa.binary())
        yield pa.record_batch([keys, batch.column("id"), batch.column("asks")], names=["key", "id", "asks"])


def _vectors(keys: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(keys.to_pylist()), np.float64).reshape(-1, size)


def _points(batches: Iterator[pa.RecordBatch], size: int, projection: Projection) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = projection.points(_vectors(batch.column("key"), size))
        yield pa.record_batch([pa.array([p.tobytes() for p in points], pa.binary())], names=["point"])


def _place(
    batches: Iterator[pa.RecordBatch], size: int, projection: Projection, splits: list[tuple[int, float]], asked: bool
) -> Iterator[pa.RecordBatch]:
    """Adds the cell of each vector, as a query or as what is searched."""
    for batch in batches:
        values = _vectors(batch.column("key"), size)
        cells = cell_of(projection.queries(values) if asked else projection.points(values), splits)
        yield batch.append_column("cell", pa.array(cells, pa.int64()))


_BLOCKS = "cell long, no long, vectors binary, ids array<array<long>>, copies array<array<long>>, low array<double>, high array<double>"


def _pack_blocks(batches: Iterator[pa.RecordBatch], size: int, projection: Projection) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and number of the block, as one row per block."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.list_(pa.list_(pa.int64()))] * 2, *[pa.list_(pa.float64())] * 2]
    names = ["cell", "no", "vectors", "ids", "copies", "low", "high"]
    held: list[tuple[bytes, list[int], list[int]]] = []
    last = None

    def block() -> pa.RecordBatch:
        keys = b"".join(x[0] for x in held)
        points = projection.points(np.frombuffer(keys, np.float64).reshape(-1, size))
        row = (*last, keys, [x[1] for x in held], [x[2] for x in held], points.min(axis=0).tolist(), points.max(axis=0).tolist())
        return pa.record_batch([pa.array([v], t) for v, t in zip(row, kinds)], names=names)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("cell", "no", "key", "ids", "copies"))):
            if held and row[:2] != last:
                yield block()
                held = []
            last = row[:2]
            held.append(row[2:])
    if held:
        yield block()


def _pack_chunks(batches: Iterator[pa.RecordBatch], size: int, rows: int) -> Iterator[pa.RecordBatch]:
    number, held = TaskContext.get().partitionId() << 32, []
    names = ["chunk", "keys"]
    for batch in batches:
        for key in batch.column("key").to_pylist():
            held.append(key)
            if len(held) == rows:
                yield pa.record_batch([pa.array([number]), pa.array([b"".join(held)], pa.binary())], names=names)
                number, held = number + 1, []
    if held:
        yield pa.record_batch([pa.array([number]), pa.array([b"".join(held)], pa.binary())], names=names)


def _pairs(batches: Iterator[pa.RecordBatch], size: int, projection: Projection) -> Iterator[tuple[int, np.ndarray, np.ndarray, Block]]:
    """Chunk, queries and bounds of every row, and the block it goes to; a block that comes again at once is kept."""
    place, block = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            if (row["cell"], row["no"]) != place:
                place = row["cell"], row["no"]
                vectors = np.frombuffer(row["vectors"].as_py(), np.float64).reshape(-1, size)
                block = Block(vectors, row["ids"].as_py(), row["copies"].as_py(), projection)
            queries = np.frombuffer(row["keys"].as_py(), np.float64).reshape(-1, size)
            given = row["bounds"].as_py()
            yield row["chunk"].as_py(), queries, np.frombuffer(given) if given else np.full(len(queries), np.inf), block


def _bound(batches: Iterator[pa.RecordBatch], size: int, k: int, projection: Projection, quantile: float) -> Iterator[pa.RecordBatch]:
    """``chunk, at, bound``: the squared distance of the last of ``k + 1`` vectors found for the query at a place of a chunk."""
    for chunk, queries, bounds, block in _pairs(batches, size, projection):
        found, _ = block.nearest(queries, bounds, k + 1, quantile)
        stretch = projection.stretch(queries)
        rows = [(chunk, q, float(projection.squared_distance(b[-1][0], stretch[q]))) for q, b in enumerate(found) if len(b) > k]
        columns = zip(*rows) if rows else ([], [], [])
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.float64()))], names=["chunk", "at", "bound"])


def _search(batches: Iterator[pa.RecordBatch], size: int, k: int, projection: Projection, quantile: float) -> Iterator[pa.RecordBatch]:
    """Of each query and block the ids of the best vectors, ``k + 1`` and more: one may be the query's own."""
    kinds = (pa.binary(), pa.float64(), pa.int64(), pa.int64())
    for _, queries, bounds, block in _pairs(batches, size, projection):
        rows = []
        for query, best in zip(queries, block.nearest(queries, bounds, k + 1, quantile)[0]):
            key, n = query.tobytes(), 0
            for score, at in best:
                if n > k:
                    break
                n += len(block.ids[at])
                rows += [(key, score, x, c) for x, c in zip(block.ids[at], block.copies[at])]
        columns = zip(*rows) if rows else ([], [], [], [])
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["key", "score", "id", "copies"])


def _route(
    batches: Iterator[pa.RecordBatch], size: int, projection: Projection, quantile: float, boxes: tuple[np.ndarray, np.ndarray, np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """Chunks with the cells they have to meet: without bounds the nearest one of each query, else all within the radius of one."""
    cells, low, high = boxes
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    for batch in batches:
        rows = []
        for chunk, keys, bounds in zip(*(batch.column(c).to_pylist() for c in ("chunk", "keys", "bounds"))):
            queries = np.frombuffer(keys, np.float64).reshape(-1, size)
            distances = box_distances(projection.queries(queries), low, high)
            known, held = None, np.zeros(len(low), bool)
            if bounds is None:
                held[distances.argmin(axis=1)] = True
            else:
                known = np.full(len(queries), np.inf)
                for x in bounds:
                    known[x["at"]] = x["bound"]
                held = (distances <= known[:, None] * quantile).any(axis=0)
            packed = None if known is None else known.tobytes()
            rows += [(int(cells[i]), chunk, keys, packed) for i in np.flatnonzero(held)]
        columns = zip(*rows) if rows else ([], [], [], [])
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["cell", "chunk", "keys", "bounds"])


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    confidence: float = CONFIDENCE,
    block: int = BLOCK,
    chunk: int = CHUNK,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row that ``is_query``."""
    usable = vectors.select(
        vectors[id_column].cast("long").alias("id"), vectors[vector_column].cast("array<double>").alias("vector"), is_query.alias("asks")
    ).filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    known = usable.agg(F.max(F.size("vector")).alias("size"), F.max(squares).alias("longest")).first()
    size = max(1, known["size"] or 0)
    projection, quantile = Projection(size, math.sqrt(known["longest"] or 1.0)), chi_square_quantile(DIMENSIONS, confidence)
    rows = usable.mapInArrow(lambda it: _packed(it, size), "key binary, id long, asks boolean")
    rows = saved(rows.groupBy("key", "id").agg(F.count(F.lit(1)).alias("copies"), F.max("asks").alias("asks")), "vectors")

    # Of equal vectors the k + 1 smallest ids; the limit works in every task before the shuffle.
    first = Window.partitionBy("key").orderBy("id")
    few = rows.select("key", "id", "copies").withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1)
    held = F.sort_array(F.collect_list(F.struct("id", "copies")))
    distinct = few.groupBy("key").agg(held.alias("held")).select("key", F.col("held.id").alias("ids"), F.col("held.copies").alias("copies"))
    distinct = saved(distinct, "distinct")
    n = distinct.count()
    cells, splits = min(CELLS, -(-n // block)), []
    if cells > 1:
        some = distinct.select("key").sample(min(1.0, sample / n), SEED)
        points = some.mapInArrow(lambda it: _points(it, size, projection), "point binary").toArrow()["point"]
        splits = fit_cells(_vectors(points, DIMENSIONS), cells)

    index = distinct.mapInArrow(lambda it: _place(it, size, projection, splits, False), "key binary, ids array<long>, copies array<long>, cell long")
    index = saved(index, "placed")
    sizes = index.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"))
    numbered = index.join(F.broadcast(sizes), "cell").withColumn("no", F.pmod(F.xxhash64("key"), F.col("blocks")))  # CELLS rows at most
    dealt = numbered.select("cell", "no", "key", "ids", "copies").repartition("cell", "no").sortWithinPartitions("cell", "no", "key")
    blocks = saved(dealt.mapInArrow(lambda it: _pack_blocks(it, size, projection), _BLOCKS), "blocks")
    sides = [f(F.get(c, F.lit(i))).alias(f"{c}{i}") for c, f in (("low", F.min), ("high", F.max)) for i in range(DIMENSIONS)]
    found = blocks.groupBy("cell").agg(*sides).collect()  # CELLS rows at most
    low, high = (np.array([[x[f"{c}{i}"] for i in range(DIMENSIONS)] for x in found]).reshape(-1, DIMENSIONS) for c in ("low", "high"))
    boxes = np.array([x["cell"] for x in found], np.int64), low, high

    asking = rows.filter("asks").select("key", F.col("id").alias("query_id"))
    alone = asking.select("key").distinct().mapInArrow(lambda it: _place(it, size, projection, splits, True), "key binary, cell long")
    near = alone.repartitionByRange("cell", "key").sortWithinPartitions("cell", "key")
    chunks = saved(near.mapInArrow(lambda it: _pack_chunks(it, size, chunk), "chunk long, keys binary"), "chunks")

    def meet(asked: DataFrame, places: DataFrame) -> DataFrame:
        """Chunks beside the blocks of ``places`` that they are sent to, those of one block together."""
        routed = asked.mapInArrow(lambda it: _route(it, size, projection, quantile, boxes), "cell long, chunk long, keys binary, bounds binary")
        sent = routed.join(places, "cell")
        # Merged, not hashed: what leaves the join is sorted by block, so a task unpacks each block once.
        return sent.join(blocks.drop("low", "high").hint("merge"), ["cell", "no"])

    one = blocks.groupBy("cell").agg(F.min("no").alias("no"))
    kind = "array<struct<at: int, bound: double>>"
    nearby = meet(chunks.withColumn("bounds", F.lit(None).cast(kind)), one)
    bounds = nearby.mapInArrow(lambda it: _bound(it, size, k, projection, quantile), "chunk long, at int, bound double")
    least = bounds.groupBy("chunk", "at").agg(F.min("bound").alias("bound"))
    least = least.groupBy("chunk").agg(F.collect_list(F.struct("at", "bound")).alias("bounds"))
    bounded = chunks.join(least, "chunk", "left").withColumn("bounds", F.coalesce("bounds", F.array().cast(kind)))
    bounded = saved(bounded.select("chunk", "keys", "bounds"), "bounded")

    candidates = meet(bounded, blocks.select("cell", "no")).mapInArrow(lambda it: _search(it, size, k, projection, quantile), _CANDIDATES)
    best = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    ranked = candidates.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1)
    ranked = ranked.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score", "copies"))).alias("best"))
    ranked = saved(ranked, "ranked")  # so that AQE can split the queries that share a vector
    others = F.filter("best", lambda x: x["id"] != F.col("query_id"))
    every = F.flatten(F.transform(others, lambda x: F.array_repeat(x, F.least(x["copies"], F.lit(k)).cast("int"))))
    joined = asking.join(ranked, "key").select("query_id", F.posexplode(F.slice(every, 1, k)).alias("at", "x"))
    return joined.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
