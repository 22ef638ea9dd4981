import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from rejoinder.llm.prefix_trie import ROOT, Shard, conversation_trie, shard_nodes, shards
from tests.llm.conftest import ordered

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
SCHEMA = "conv_id long, turn long, role string, text string, path string, pos string, n string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt(rows):
    own = defaultdict(list)
    for key, turn, role, text, *_ in rows:
        if key is not None:
            own[key].append((turn is not None, turn or 0, role or "", text or ""))
    own = {key: [t[2:] for t in sorted(turns)] for key, turns in own.items()}
    made = {}
    for key, turns in own.items():
        h = zlib.crc32(str(key).encode()) % 4
        made[key] = own.get(key - key % 20, [])[:h] + turns[h:]
    return made


def brute(rows):
    made = rebuilt(rows)
    members, ends, children = defaultdict(set), defaultdict(list), defaultdict(set)
    for key, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(key)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(key)
    found = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(WORD.findall(n[-1][1])) for n in below if n)
        leaves = sum(not children[n] for n in below)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        found.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves, saved, digest))
    return ordered(found)


def made_up(rng, n=90, alphabet=2, longest=7):
    rows = []
    for key in rng.sample(range(140), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((key, turn, rng.choice(("user", "assistant", None)), rng.choice(("a", "b c", "", None)[: alphabet + 1]), "?", "?", "?"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [(2048, 1 << 15), (3, 1 << 15), (50, 4), (1, 1)])
def test_like_brute_force(spark, sizes):
    rows = made_up(random.Random(sizes[0]))
    rows += [(None, 0, "user", "x", "?", "?", "?"), (200, None, "user", "first", "?", "?", "?"), (200, 0, "user", "second", "?", "?", "?")]
    rows += [(400, t, "user", "again and again", "?", "?", "?") for t in range(60)] + [(401, t, "user", "again and again", "?", "?", "?") for t in range(40)]
    rows += [(500, 0, "user", "word " * 30_000, "?", "?", "?")] * 3
    found = conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), *sizes)
    assert found.columns == COLUMNS
    assert ordered(map(tuple, found.collect())) == brute(rows)


def test_many_copies_and_no_rows(spark):
    rows = [(key, turn, "user", f"t{turn}", "?", "?", "?") for key in range(0, 3000, 2) for turn in range(2)]
    given = spark.createDataFrame(rows, SCHEMA)
    assert ordered(map(tuple, conversation_trie(given, 64).collect())) == brute(rows)
    assert conversation_trie(given.limit(0)).collect() == []


def test_shards_hold_few_turns_and_lose_none():
    rng = random.Random(4)
    rows, lengths = [], {}
    for key in range(200):
        lengths[key] = rng.choice((0, 1, 2, 30))
        rows.append((key, 0, None, None))
        rows += [(key, pos, bytes([rng.randint(0, 1)]), 1) for pos in range(1, lengths[key] + 1)]
    seen, ends = defaultdict(int), []
    for shard, ended in shards(iter(rows), 5, 8):
        assert len(shard.ids) <= 5 and shard.n_turns <= 9
        nodes = list(shard_nodes(shard, ended))
        for x in nodes:
            ends += x.ends
        assert sum(x.n for x in nodes if x.depth) == shard.n_turns
        for key, turns in zip(shard.ids, shard.turns):
            seen[key] += len(turns)
    assert dict(seen) == lengths and sorted(ends) == list(range(200))


def test_a_shard_with_nothing():
    assert list(shard_nodes(Shard())) == []
    assert [(x.path, x.n, x.ends) for x in shard_nodes(Shard(None, [3, 9], [[], []]))] == [(ROOT, 2, [3, 9])]
