"""Near-duplicate documents by word shingles, with candidates from an LSH forest.

1. Every document gets the hash of its whole set of shingles and a MinHash signature.
   Documents with equal sets form a class; only classes go on.
2. Forest: a tree is an order of the classes by some of their signature's values. All
   trees are sorted together, range by range. In sorted order the classes with the
   longest common prefix stand next to each other; each class is paired with its
   ``WIDTH`` next neighbours that share at least ``DEPTH`` values. Sparse regions are
   thereby compared whole at a low depth; in dense regions, whose members step 4 joins
   exactly, each is paired with the next one only.
3. Classes in regions with more members than neighbours take part in a second, larger
   forest with deeper prefixes, in which each is paired with those of its next ``REACH``
   neighbours in other components whose signatures are most alike: what is already connected needs no further link, so a group of
   thousands of near copies costs a few pairs per member and not all pairs.
4. Neither forest looks beyond a fixed number of neighbours, so classes in crowded regions
   (many texts around one template) are then joined exactly: two similar sets share one of
   the rarest shingles of each (prefix filter), at a position that leaves enough behind it
   (position filter). Pairs within a component need no link and are left out. First each
   class meets its next partner per shingle, then all that still are in other components.
5. Pairs are thinned by the signatures and confirmed on the full sets. Components come
   from the confirmed links alone.

With a similarity of 0.75 two classes share a region in no tree of the first forest with
probability (1 - 0.75**2)**16, 2 in a million. Regions of up to ``WIDTH`` + 1 classes are
compared whole; every member of a larger one goes through the exact join.

A document without words has no shingles and no links. Rows without an id take no part in
links and stay alone. Rows that share an id but not their text are separate members; equal
rows fall into one class. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.components import connected_components
from rejoinder.llm.frames import bound_batches, chunks, discard, saved
from rejoinder.llm.hashing import mix, shingle_sets, texts_in_chunks

SHINGLE = 5
PERCENT = 75
VALUES = 128
TREES, DEPTH = 16, 2
MORE_TREES, MORE_DEPTH, MORE_WIDTH = 48, 3, 2
KEY_VALUES = 6
WIDTH = 4
REACH = 32
#: Equal values of two signatures, of 128. A link's are 96 on average with a deviation of 4.9;
#: fewer than this come once in half a million links of the least similarity.
ALIKE = 74
#: Counters of shingles for the exact join, and how many rows of one shingle meet in one task.
COUNTERS = 1 << 21
CELL_ROWS = 4096
RUN_HASHES = 1 << 21
SEED = 11

_U = np.uint64
_RNG = np.random.default_rng(SEED)
_XOR = _RNG.integers(0, 2**63, VALUES, dtype=np.uint64)
_TIMES = _RNG.integers(0, 2**63, VALUES, dtype=np.uint64) | _U(1)
_CHOSEN = [_RNG.permutation(VALUES)[:KEY_VALUES] for _ in range(TREES + MORE_TREES)]


def _node(own: np.ndarray) -> bytes:
    """16 bytes for a set of hashes, the same in any order."""
    return np.array([mix(own).sum(), mix(own ^ _U(0x5851F42D4C957F2D)).sum() + _U(len(own))], np.uint64).tobytes()


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in texts_in_chunks(batches, "text"):
        sets = shingle_sets(data, offsets, size)
        counts = np.array([len(s) for s in sets])
        full = np.flatnonzero(counts)
        signatures: list[bytes | None] = [None] * len(sets)
        if len(full):
            flat = np.concatenate([sets[i] for i in full])
            starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
            signed = np.empty((len(full), VALUES), ">u4")
            for k in range(VALUES):
                signed[:, k] = np.minimum.reduceat((((flat ^ _XOR[k]) * _TIMES[k]) >> _U(32)).astype(np.uint32), starts)
            for row, i in enumerate(full):
                signatures[i] = signed[row].tobytes()
        nodes = [_node(s) if len(s) else None for s in sets]
        yield pa.record_batch(
            [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.binary())],
            names=["doc_id", "n", "node", "signature"],
        )


def _plant(batches: Iterator[pa.RecordBatch], first: int, trees: int) -> Iterator[pa.RecordBatch]:
    """Each class once per tree, with the tree's number and its values in order as sort key."""
    for batch in batches:
        if not len(batch):
            continue
        signed = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(len(batch), VALUES, 4)
        for t in range(first, first + trees):
            keys = np.empty((len(batch), 1 + 4 * KEY_VALUES), np.uint8)
            keys[:, 0] = t
            keys[:, 1:] = signed[:, _CHOSEN[t]].reshape(len(batch), -1)
            yield pa.record_batch(
                [pa.array([k.tobytes() for k in keys], pa.binary()), *(batch.column(c) for c in _PLANTED[1:])], names=_PLANTED
            )


_PLANTED = ["key", "node", "component", "sketch"]
_PAIR_SCHEMA = "a binary, b binary, key binary, component binary, sketch binary, dense boolean"


def _neighbours(batches: Iterator[pa.RecordBatch], depth: int, edges: bool, width: int = WIDTH) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours in sorted order, members of dense regions, and the rows at both ends.

    Where rows carry sketches, the ``width`` most alike of the next ``REACH`` are taken, else
    the next ``width``. The ends (``a`` with its ``key``) are compared with those of the
    next range later.
    """
    names = [p.split()[0] for p in _PAIR_SCHEMA.split(", ")]
    kinds = [*[pa.binary()] * 5, pa.bool_()]
    held: list[tuple] = []
    head: list[tuple] = []
    same_bytes = 1 + 4 * depth

    def rows_of(rows: list[tuple], settled: int) -> list[tuple]:
        """What the first ``settled`` rows find among those behind them."""
        if settled <= 0:
            return []
        prefix = np.frombuffer(b"".join(r[0][:same_bytes] for r in rows), np.uint8).reshape(len(rows), same_bytes)
        codes = np.unique(np.array([r[2] for r in rows], "S16"), return_inverse=True)[1]
        sketches = None
        if rows[0][3] is not None:
            sketches = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), VALUES)
        found = []
        taken = np.zeros(len(rows), np.int64)
        crowded = np.zeros(len(rows), bool)
        alike = np.zeros((REACH, len(rows)), np.int16)  # equal values of the sketches, by step
        for step in range(1, min(REACH, len(rows) - 1) + 1):
            same = (prefix[step:] == prefix[:-step]).all(axis=1)
            if not same.any():
                break
            if step == width + 1:
                begins = np.flatnonzero(same[:settled])
                members = np.unique(begins[:, None] + np.arange(width + 2))
                found.extend((rows[i][1], *[None] * 4, True) for i in members.tolist())
                crowded[members] = True
            other = same & (codes[step:] != codes[:-step])
            if sketches is None:
                alike[step - 1, :-step] = np.where(other & (taken[:-step] < width), VALUES, 0)
                taken[:-step] += other
            else:
                at = np.flatnonzero(other)
                alike[step - 1, at] = (sketches[at] == sketches[at + step]).sum(axis=1)
        best = np.argsort(-alike, axis=0, kind="stable")[:width]
        if sketches is None and edges:  # members of a dense region meet in the exact join
            alike[:, crowded] *= np.arange(REACH)[:, None] == best[0, crowded]
        for step in best:
            near = np.flatnonzero(np.take_along_axis(alike, step[None], axis=0)[0] >= ALIKE)
            for i, j in zip(near.tolist(), (near + step[near] + 1).tolist()):
                if i < settled:
                    a, b = rows[i][1], rows[j][1]
                    found.append((min(a, b), max(a, b), *[None] * 4))
        return found

    for batch in batches:
        new = list(zip(*(batch.column(c).to_pylist() for c in _PLANTED)))
        if len(head) < REACH:
            head.extend(new[: REACH - len(head)])
        held.extend(new)
        settled = len(held) - REACH
        found = rows_of(held, settled)
        held = held[max(0, settled) :]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), kinds)] if found else [pa.array([], k) for k in kinds], names=names)
    found = rows_of(held, len(held))
    if edges:
        found += [(node, None, key, component, sketch, None) for key, node, component, sketch in {*head, *held[-REACH:]}]
    if found:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)


def _candidates(
    classes: DataFrame, first: int, trees: int, depth: int, width: int, purpose: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of classes ``a, b``, the members ``node`` of dense regions, and the table both come from."""
    planted = classes.select("node", "signature", "component", "sketch").mapInArrow(
        lambda it: _plant(it, first, trees), "key binary, node binary, component binary, sketch binary"
    )
    ordered = planted.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    found = saved(ordered.mapInArrow(lambda it: _neighbours(it, depth, True, width), _PAIR_SCHEMA), purpose)
    # At most 2 * REACH rows per range, whatever the number of classes.
    ends = found.filter("key IS NOT NULL").select("key", F.col("a").alias("node"), "component", "sketch")
    across = ends.coalesce(1).sortWithinPartitions("key", "node").mapInArrow(lambda it: _neighbours(it, depth, False, width), _PAIR_SCHEMA)
    both = found.unionByName(across)
    dense = found.filter("dense").select(F.col("a").alias("node")).distinct()
    return both.filter("b IS NOT NULL").select("a", "b").distinct(), dense, found


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches agree in ``ALIKE`` places."""
    for batch in batches:
        if not len(batch):
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(len(batch), VALUES) for c in ("xs", "ys"))
        near = (x == y).sum(axis=1) >= ALIKE
        yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(near))


def _thinned(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    def side(end: str, short: str) -> DataFrame:
        return classes.select(F.col("node").alias(end), F.col("n").alias(f"{short}n"), F.col("sketch").alias(f"{short}s"))

    near = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    near = near.filter(100 * F.least("xn", "yn") >= percent * F.greatest("xn", "yn"))
    return near.select("a", "b", "xs", "ys").mapInArrow(_thin, "a binary, b binary")


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.searchsorted(x, y)
            both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
            kept.append(100 * both >= percent * (len(x) + len(y) - both))
        yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    x, y = (sets.select(F.col("node").alias(end), F.col("own").alias(own)) for end, own in (("a", "x"), ("b", "y")))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(lambda it: _confirm(it, percent), "a binary, b binary")


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in texts_in_chunks(batches, "text"):
        rows = [(_node(s), s.tobytes()) for s in shingle_sets(data, offsets, size) if len(s)]
        if rows:
            yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*rows)], names=["node", "own"])


def _in_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with all hashes of their sets ``own`` and the row of each."""
    for batch in batches:
        for part in chunks(batch, "own", 8 * RUN_HASHES):
            own = part.column("own").to_pylist()
            sizes = np.array([len(s) // 8 for s in own])
            yield part, np.frombuffer(b"".join(own), np.uint64), np.repeat(np.arange(len(own)), sizes)


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(40)).astype(np.int64) & (COUNTERS - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the counters of shingles: how many sets, and the least and largest component among them."""
    for part, hashes, row in _in_runs(batches):
        counter, group = _counter(hashes), part.column("part").to_numpy()[row]
        order = np.argsort(counter, kind="stable")
        counter, group = counter[order], group[order]
        starts = np.flatnonzero(np.concatenate([[True], counter[1:] != counter[:-1]]))
        counts = np.diff(np.append(starts, len(counter)))
        columns = [counter[starts].astype(np.int32), counts, np.minimum.reduceat(group, starts), np.maximum.reduceat(group, starts)]
        yield pa.record_batch([pa.array(c) for c in columns], names=["counter", "rows", "low", "high"])


def _shingle_counts(crowded: DataFrame) -> np.ndarray:
    """Sets per counter; 0 where all are in one component. ``COUNTERS`` numbers, whatever the data."""
    found = crowded.select("part", "own").mapInArrow(_count, "counter int, rows long, low long, high long")
    found = found.groupBy("counter").agg(F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
    mixed = found.select("counter", F.when(F.col("low") < F.col("high"), F.col("rows")).otherwise(-F.col("rows")).alias("rows"))
    table = mixed.toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[table.column("counter").to_numpy()] = table.column("rows").to_numpy()
    return counts


_PREFIX = ["token", "cell", "n", "rest", "part", "block", "node"]
_PREFIX_SCHEMA = "token long, cell long, n int, rest int, part long, block int, node binary"


def _prefixes(batches: Iterator[pa.RecordBatch], counts: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """The rarest shingles of each set, as many as a similar set shares one of, if other components have them.

    ``rest`` counts the set's shingles from there on. The sets of a frequent shingle are dealt
    to blocks, and every two blocks meet in a cell.
    """
    blocks_of = -(-np.abs(counts) // CELL_ROWS)
    for part, hashes, row in _in_runs(batches):
        counter = _counter(hashes)
        order = np.lexsort((hashes, np.abs(counts[counter]), row))
        hashes, counter = hashes[order], counter[order]
        sizes = np.bincount(row, minlength=len(part))
        begins = np.cumsum(sizes) - sizes
        rest = sizes[row] - (np.arange(len(row)) - begins[row])
        kept = np.flatnonzero((100 * rest >= percent * sizes[row]) & (counts[counter] > 0))
        own = np.array([int.from_bytes(n[:4], "little") for n in part.column("node").to_pylist()], np.int64)
        blocks = blocks_of[counter[kept]]
        block = own[row[kept]] % blocks
        copy = np.repeat(np.arange(len(kept)), blocks)
        other = np.arange(len(copy)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        cell = np.minimum(block[copy], other) * blocks[copy] + np.maximum(block[copy], other)
        for begin in range(0, len(copy), 1 << 16):
            c = copy[begin : begin + (1 << 16)]
            at = row[kept[c]]
            columns = [
                hashes[kept[c]].view(np.int64), cell[begin : begin + (1 << 16)], sizes[at].astype(np.int32), rest[kept[c]].astype(np.int32),
                part.column("part").to_numpy()[at], block[c].astype(np.int32),
            ]
            yield pa.record_batch([*(pa.array(x) for x in columns), part.column("node").take(pa.array(at))], names=_PREFIX)


def _met(rows: pa.Table, percent: int, one: bool) -> pa.RecordBatch:
    """Pairs of different components in the same cell that can be similar by sizes and positions.

    Rows are sorted by token, cell and size, so a pair's bounds only tighten with the steps
    between them. With ``one`` each row takes its first partner only.
    """
    token, cell, n, rest, part, block = (rows.column(c).to_numpy() for c in _PREFIX[:-1])
    n, rest = n.astype(np.int64), rest.astype(np.int64)
    crossing = np.zeros(len(rows), bool)  # cells of two blocks; each block has one of its own
    same = (token[1:] == token[:-1]) & (cell[1:] == cell[:-1])
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    sizes = np.diff(np.append(starts, len(rows)))
    crossing[:] = np.repeat(np.minimum.reduceat(block, starts) != np.maximum.reduceat(block, starts), sizes)
    active, step, firsts, seconds = np.arange(len(rows)), 1, [], []
    while True:
        active = active[active + step < len(rows)]
        after = active + step
        total = percent * (n[active] + n[after])
        open_ = (token[active] == token[after]) & (cell[active] == cell[after]) & (percent * n[after] <= 100 * n[active])
        open_ &= (100 + percent) * rest[active] >= total
        active, after, total = active[open_], after[open_], total[open_]
        if not len(active):
            break
        good = ((100 + percent) * rest[after] >= total) & (part[active] != part[after]) & (~crossing[active] | (block[active] != block[after]))
        firsts.append(active[good])
        seconds.append(after[good])
        if one:
            active = active[~good]
        step += 1
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (firsts, seconds))
    nodes = rows.column("node").to_pylist()
    pairs = list({(min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for i, j in zip(a.tolist(), b.tolist())})
    return pa.record_batch([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _meet(batches: Iterator[pa.RecordBatch], percent: int, one: bool) -> Iterator[pa.RecordBatch]:
    """The pairs of all cells; whole cells are held at a time."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count < 1 << 17:
            continue
        rows = pa.Table.from_batches(held)
        token, cell = rows.column("token").to_numpy(), rows.column("cell").to_numpy()
        begins = np.flatnonzero((token[1:] != token[:-1]) | (cell[1:] != cell[:-1]))
        if len(begins):
            whole = int(begins[-1]) + 1
            yield _met(rows.slice(0, whole), percent, one)
            held = rows.slice(whole).to_batches()
            count -= whole
    if count:
        yield _met(pa.Table.from_batches(held), percent, one)


def _crowded_pairs(classes: DataFrame, sets: DataFrame, components: DataFrame, percent: int, one: bool) -> DataFrame:
    """Pairs of classes ``a, b`` in different components that an exact prefix join leaves."""
    named = classes.select("node").join(components, "node", "left")
    named = named.select("node", F.xxhash64(F.coalesce("component", "node")).alias("part"))
    crowded = saved(sets.join(named, "node"), "crowded")
    counts = _shingle_counts(crowded)
    rows = crowded.select("node", "part", "own").mapInArrow(lambda it: _prefixes(it, counts, percent), _PREFIX_SCHEMA)
    rows = rows.repartition("token", "cell").sortWithinPartitions("token", "cell", "n")
    pairs = saved(rows.mapInArrow(lambda it: _meet(it, percent, one), "a binary, b binary").distinct(), "crowded-pairs")
    discard(crowded)
    return pairs


def _low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signed = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(len(batch), VALUES, 4)
        sketch = pa.array([row.tobytes() for row in signed[:, :, 3]], pa.binary())
        yield pa.record_batch([*batch.columns, sketch], names=[*batch.schema.names, "sketch"])


def _joined(components: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links."""
    tree = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return saved(connected_components(links.unionByName(tree)), "all-components")


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row.

    The component is the least id among all documents that links lead to.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    signed = saved(
        texts.mapInArrow(lambda it: _sign(it, size), "doc_id long, n long, node binary, signature binary"), "signatures"
    )
    members = signed.filter("n > 0 AND doc_id IS NOT NULL")
    firsts = members.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    classes = saved(
        firsts.mapInArrow(_low_bytes, "node binary, first long, n long, signature binary, sketch binary"), "classes"
    )
    alone = classes.withColumns({"component": F.col("node"), "sketch": F.lit(None).cast("binary")})
    pairs, dense, forest = _candidates(alone, 0, TREES, DEPTH, WIDTH, "forest")
    near = saved(_thinned(pairs, classes, percent), "near-pairs")
    dense = saved(dense, "dense")
    discard(forest)
    needed = near.select(F.col("a").alias("node")).union(near.select("b")).union(dense).distinct()
    wanted = classes.join(needed, "node").select(F.col("first").alias("doc_id"), F.col("node").alias("own_node"))
    own = texts.join(wanted, "doc_id", "left_semi").select("text")
    sets = saved(own.mapInArrow(lambda it: _sets(it, size), "node binary, own binary").dropDuplicates(["node"]), "sets")
    links = saved(_confirmed(near, sets, percent), "near-links")
    components = saved(connected_components(links), "components")
    discard(near, links)
    crowded = classes.join(dense, "node").join(components, "node", "left")
    crowded = crowded.withColumn("component", F.coalesce("component", "node"))
    more, _, forest = _candidates(crowded, TREES, MORE_TREES, MORE_DEPTH, MORE_WIDTH, "second-forest")
    more = saved(_confirmed(more, sets, percent), "more-links")  # alike already
    discard(forest)
    components = _joined(components, more)
    discard(more)
    for one in (True, False):
        pairs = _crowded_pairs(classes.join(dense, "node"), sets, components, percent, one)
        near = saved(_thinned(pairs, classes, percent), "crowded-near")
        more = saved(_confirmed(near, sets, percent), "crowded-links")
        if not more.isEmpty():
            components = _joined(components, more)
        discard(pairs, near, more)
    discard(sets, dense)
    named = classes.select("node", "first").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = saved(named.join(least, "component").select("node", "component_id"), "named")
    discard(classes, components)
    joined = signed.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")).join(named, "node", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The rows with all their columns whose id is the least of their component, and rows without an id.

    Of rows that repeat an id and its text one stays.
    """
    found = near_duplicates(docs, percent, size)
    kept = found.filter("doc_id = component_id").select("doc_id").distinct()
    firsts = docs.join(kept, "doc_id", "left_semi")
    if not docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty():
        firsts = firsts.dropDuplicates(["doc_id", "text"])
    return firsts.select(docs.columns).union(docs.filter("doc_id IS NULL"))
