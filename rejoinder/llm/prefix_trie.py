"""A trie of conversations over their turns, from vertical bitmaps.

Conversations are first rebuilt: conversation ``c`` begins with the first ``h`` turns of the
first conversation of its group of ``GROUP`` ids, then come its own turns after its first
``h``, where ``h`` is a checksum of its id modulo 4. From there on a turn is a 128-bit hash of
role and text, and its number of words.

The rebuilt turns are dealt by ranges of the conversation id. A task reads its range in order and cuts
it into shards of a bounded number of conversations and turns; a conversation too long for one
shard goes on in the next, below the node it has reached. A shard is indexed vertically: for
each (position, turn) the bitset of its conversations with that turn there. Depth first,
the bitset of a node is intersected with the posting of the next turn of its least member,
which gives a child with its count of members; those members are taken out, and so on until none is left. What
remains because it ends here is the node's list of ends.

Nodes of all shards are brought together by the hash of their path; each shard sends one row
per node, however many members it has there. Sums over subtrees need each node of the whole
trie once. It is given to the shard that holds its smallest member: that conversation runs
through all ancestors of the node too, so the shard can add it up the path, and sums over the shards
are the sums of the trie. The list of ends of a node is hashed as a stream of sorted pieces;
it is never held, though by its nature one task hashes one list.

Null roles and texts are empty. Turns are ordered by turn (null first), equal ones by role, the
first ``TIE`` characters of the text and its hash; repeated rows are turns of their own. Rows without a conversation id take no part. A group
whose first conversation is absent lends no turns, and a conversation that is left without turns is a member
of the root alone. Empty and very long texts are only hashed and counted. A conversation of
any length takes bounded memory, but is read by one task. An empty table has no node, not
even the root. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rejoinder.llm.frames import saved

GROUP = 20
LENT = 4
SHARD_CONVERSATIONS = 2048
SHARD_TURNS = 1 << 15
ENDS_PER_PIECE = 512
TIE = 64

ROOT = hashlib.blake2b(b"", digest_size=16).digest()

_TURNS = "array<struct<pos: long, told: struct<turn: binary, words: long>>>"
_NODES = (
    "part int, shard int, seq int, below boolean, path binary, above binary, depth long, conv_id long, n long, words long, "
    "ends array<struct<first: long, ids: string>>"
)
_NODES_SCHEMA = pa.schema(
    [
        ("part", pa.int32()), ("shard", pa.int32()), ("seq", pa.int32()), ("below", pa.bool_()), ("path", pa.binary()),
        ("above", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n", pa.int64()), ("words", pa.int64()),
        ("ends", pa.list_(pa.struct([("first", pa.int64()), ("ids", pa.string())]))),
    ]
)


# --- conversations -----------------------------------------------------------


def _turn_hash(role: Column, text: Column) -> Column:
    """128 bits; the length of the role keeps ("ab", "c") from ("a", "bc")."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, turn, words`` of every rebuilt conversation, and a row with ``pos`` 0 for each.

    One shuffle by group serves both windows. A conversation with very many turns is
    sorted, not held; a group lends at most ``LENT - 1`` turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.col("conv_id").cast("long")
    given = conversations.filter("conv_id IS NOT NULL").select(
        (key - key % GROUP).alias("first"),
        key.alias("conv_id"),
        "turn",
        role.alias("role"),
        F.left(text, F.lit(TIE)).alias("begin"),
        _turn_hash(role, text).alias("hash"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    group = Window.partitionBy("first")
    by_turn = Window.partitionBy("first", "conv_id").orderBy(F.asc_nulls_first("turn"), "role", "begin", "hash")
    own = given.repartition("first").select(
        "first",
        "conv_id",
        F.row_number().over(by_turn).cast("long").alias("pos"),
        F.struct(F.col("hash").alias("turn"), "words").alias("told"),
    )
    lent = F.when((F.col("conv_id") == F.col("first")) & (F.col("pos") < LENT), F.struct("pos", "told"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT).cast("int")
    lending = own.withColumn("lent", F.sort_array(F.collect_list(lent).over(group)).cast(_TURNS))
    known = lending.withColumn("lent", F.slice("lent", 1, h))
    none = F.array().cast(_TURNS)
    mark = F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.lit(None).alias("told"))).cast(_TURNS)
    begun = F.when(F.col("pos") == 1, F.concat(mark, "lent")).otherwise(none)
    after = F.array(F.struct((F.size("lent") + F.col("pos") - h).alias("pos"), "told")).cast(_TURNS)
    kept = F.when(F.col("pos") > h, after).otherwise(none)
    return known.select("conv_id", F.inline(F.concat(begun, kept))).select("conv_id", "pos", "told.turn", "told.words")


# --- one shard ---------------------------------------------------------------


@dataclass
class Shard:
    """Consecutive conversations; all begin at the root but the first, which may go on below ``entry``."""

    entry: tuple[bytes, int] | None = None
    ids: list[int] = field(default_factory=list)
    turns: list[list[tuple[bytes, int]]] = field(default_factory=list)
    n_turns: int = 0


@dataclass
class Node:
    path: bytes
    above: bytes | None
    depth: int
    conv_id: int
    n: int
    words: int
    ends: list[int]
    below: bool = False


def child_path(path: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(path + turn, digest_size=16).digest()


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def shard_nodes(shard: Shard, ended: bool = True) -> Iterator[Node]:
    """The nodes of a shard, each before those below it.

    Where the first conversation goes on from an earlier shard, the node it has reached comes
    first, marked ``below``, without a count. With ``ended`` off the last conversation goes on in the next shard
    and ends nowhere here.
    """
    postings: dict[tuple[int, bytes], int] = {}
    lasts: dict[int, int] = {}
    begins = [0] * len(shard.ids)
    if shard.entry:
        begins[0] = shard.entry[1]
    for i, turns in enumerate(shard.turns):
        for depth, (turn, _) in enumerate(turns, begins[i]):
            postings[depth, turn] = postings.get((depth, turn), 0) | 1 << i
        if ended or i < len(shard.ids) - 1:
            depth = begins[i] + len(turns)
            lasts[depth] = lasts.get(depth, 0) | 1 << i
    everyone = (1 << len(shard.ids)) - 1
    todo: list[tuple[bytes, bytes | None, int, int, int, bool]] = []
    if shard.entry:
        if everyone > 1:
            todo.append((ROOT, None, 0, 0, everyone ^ 1, False))
        todo.append((shard.entry[0], None, shard.entry[1], 0, 1, True))
    elif everyone:
        todo.append((ROOT, None, 0, 0, everyone, False))
    while todo:
        path, above, depth, words, members, below = todo.pop()
        least = (members & -members).bit_length() - 1
        ends = members & lasts.get(depth, 0)
        yield Node(path, above, depth, shard.ids[least], 0 if below else members.bit_count(), words, [shard.ids[i] for i in _bits(ends)], below)
        left = members & ~ends
        while left:
            first = (left & -left).bit_length() - 1
            told = shard.turns[first]
            if depth - begins[first] >= len(told):  # goes on in the next shard
                left ^= 1 << first
                continue
            turn, n_words = told[depth - begins[first]]
            child = left & postings[depth, turn]
            todo.append((child_path(path, turn), path, depth + 1, n_words, child, False))
            left &= ~child


def shards(
    rows: Iterator[tuple[int, int, bytes | None, int | None]], conversations: int = SHARD_CONVERSATIONS, turns: int = SHARD_TURNS
) -> Iterator[tuple[Shard, bool]]:
    """Cuts sorted rows ``conv_id, pos, turn, words`` into shards; the second value tells whether the last conversation ends."""
    shard, path = Shard(), ROOT  # the path of the conversation that is being read
    for key, pos, turn, words in rows:
        if pos == 0:
            if len(shard.ids) >= conversations or shard.n_turns >= turns:
                yield shard, True
                shard = Shard()
            shard.ids.append(key)
            shard.turns.append([])
            path = ROOT
            continue
        if shard.n_turns >= turns and shard.turns[-1]:
            yield shard, False
            shard = Shard((path, pos - 1), [key], [[]])
        shard.turns[-1].append((turn, words))
        shard.n_turns += 1
        path = child_path(path, turn)
    if shard.ids:
        yield shard, True


def _index(batches: Iterator[pa.RecordBatch], conversations: int, turns: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple[int, int, bytes | None, int | None]]:
        for batch in batches:
            yield from zip(*(batch.column(name).to_pylist() for name in ("conv_id", "pos", "turn", "words")))

    for number, (shard, ended) in enumerate(shards(rows(), conversations, turns)):
        held = []
        for seq, x in enumerate(shard_nodes(shard, ended)):
            pieces = [x.ends[i : i + ENDS_PER_PIECE] for i in range(0, len(x.ends), ENDS_PER_PIECE)]
            ends = [{"first": ids[0], "ids": ",".join(map(str, ids))} for ids in pieces]
            held.append((part, number, seq, x.below, x.path, x.above, x.depth, x.conv_id, x.n, x.words, ends))
            if len(held) == 4096:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), _NODES_SCHEMA)], schema=_NODES_SCHEMA)


# --- sums over subtrees ------------------------------------------------------

_SUMS = "path binary, saved_tokens long, n_leaves long, parent_conv_id long"


def subtree_sums(rows: Iterator[dict]) -> Iterator[tuple[bytes, int, int, int | None]]:
    """``path, saved tokens, leaves, parent's id`` of each node of a range of shards, summed over what its shards own.

    Shards come last one first, their nodes each before those below it. What hangs below
    the node a conversation had reached at the end of a shard has thus been summed already
    when that node is met.
    """
    open_nodes: list[list] = []  # path, depth, saved tokens, leaves, whole trie's id, parent's id, below
    carried: tuple[bytes, int, int] | None = None
    shard = None

    def close() -> Iterator[tuple[bytes, int, int, int | None]]:
        nonlocal carried
        path, _, saved_tokens, leaves, _, parent, below = open_nodes.pop()
        if below:
            carried = (path, saved_tokens, leaves)
            return
        if open_nodes:
            open_nodes[-1][2] += saved_tokens
            open_nodes[-1][3] += leaves
        yield path, saved_tokens, leaves, parent

    for row in rows:
        fresh = (row["part"], row["shard"]) != shard
        if fresh:
            while open_nodes:
                yield from close()
            if shard and shard[0] != row["part"]:
                carried = None
            shard, came = (row["part"], row["shard"]), carried
            carried = None
        while open_nodes and (open_nodes[-1][1] >= row["depth"]):
            yield from close()
        owned = row["n"] > 0 and row["conv_id"] == row["whole_id"]
        saved_tokens = (row["whole_n"] - 1) * row["words"] if owned else 0
        leaves = int(owned and row["n_children"] == 0)
        if came and came[0] == row["path"]:
            saved_tokens, leaves = saved_tokens + came[1], leaves + came[2]
            came = None
        parent = open_nodes[-1][4] if open_nodes and not row["below"] else None
        open_nodes.append([row["path"], row["depth"], saved_tokens, leaves, row["whole_id"], parent, row["below"]])
    while open_nodes:
        yield from close()


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    schema = pa.schema([("path", pa.binary()), *((n, pa.int64()) for n in ("saved_tokens", "n_leaves", "parent_conv_id"))])
    held = []
    for found in subtree_sums(rows()):
        held.append(found)
        if len(held) == 4096:
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


# --- lists of ends -----------------------------------------------------------


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per path from its sorted pieces."""
    path, digest = None, None
    for batch in batches:
        paths, digests = [], []
        for key, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
            if key != path:
                if digest:
                    paths.append(path)
                    digests.append(digest.hexdigest())
                path, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.record_batch([pa.array(paths, pa.binary()), pa.array(digests, pa.string())], names=["path", "ends_sha256"])
    if digest:
        yield pa.record_batch([pa.array([path], pa.binary()), pa.array([digest.hexdigest()])], names=["path", "ends_sha256"])


# --- the whole trie ----------------------------------------------------------


def conversation_trie(conversations: DataFrame, per_shard: int = SHARD_CONVERSATIONS, turns_per_shard: int = SHARD_TURNS) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    turns = saved(rebuilt_turns(conversations), "trie-turns")
    dealt = turns.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "pos")
    nodes = saved(dealt.mapInArrow(lambda it: _index(it, per_shard, turns_per_shard), _NODES), "trie-nodes")

    counted = nodes.filter("NOT below").groupBy("path").agg(
        F.sum("n").alias("whole_n"),
        F.min("conv_id").alias("whole_id"),
        F.max("depth").alias("depth"),
        F.max("above").alias("above"),
    )
    children = counted.filter("above IS NOT NULL").groupBy(F.col("above").alias("path")).agg(F.count(F.lit(1)).alias("n_children"))
    whole = counted.join(children, "path", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    whole = saved(whole.drop("above"), "trie-whole")

    told = nodes.drop("above", "ends", "depth").join(whole, "path")
    ordered = told.repartition("part").sortWithinPartitions("part", F.desc("shard"), "seq")
    sums = ordered.mapInArrow(_sum, _SUMS).groupBy("path").agg(
        F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"), F.max("parent_conv_id").alias("parent_conv_id")
    )
    pieces = nodes.select("path", F.inline("ends")).repartition("path").sortWithinPartitions("path", "first")
    ends = pieces.select("path", "ids").mapInArrow(_hash_ends, "path binary, ends_sha256 string")
    found = whole.join(sums, "path").join(ends, "path", "left")
    return found.select(
        F.col("whole_id").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("whole_n").alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
