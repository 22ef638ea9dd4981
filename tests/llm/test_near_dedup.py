import random
import re

import pyarrow as pa
import pytest

from rejoinder.llm import components
from rejoinder.llm.components import connected_components
from rejoinder.llm.frames import BATCH_BYTES
from rejoinder.llm.hashing import shingle_sets
from rejoinder.llm.near_dedup import _PLANTED, DEPTH, KEY_VALUES, _neighbours, drop_near_duplicates, near_duplicates
from tests.llm.conftest import TEXTS


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(k, shingles(t)) for k, t in rows if k is not None]
    least = {k: k for k, _ in sets}
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(i)] = find(j)
    groups = {}
    for i, (k, _) in enumerate(sets):
        groups.setdefault(find(i), []).append(k)
    result = []
    for i, (k, x) in enumerate(sets):
        result.append((k, len(x), min(groups[find(i)])))
    assert least
    return sorted(result)


def check(spark, rows):
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in found if r.doc_id is not None) == brute(rows)


def varied(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_copies(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(150)]
    base = rng.choices(vocabulary, k=120)
    rows += [(1000 + i, varied(rng, base, rng.randint(0, 6))) for i in range(200)]
    rows += [(2000 + i, varied(rng, rows[i][1].split() or ["x"], rng.randint(0, 2))) for i in range(100)]
    rows += [(3000 + i, rows[i][1].upper() + " \n") for i in range(30)]
    rng.shuffle(rows)
    check(spark, rows)


def test_chains(spark):
    words = [f"w{i}" for i in range(200)]
    check(spark, [(50 - i, " ".join(words[i * 4 : i * 4 + 60])) for i in range(30)])


def test_links_in_a_crowded_region(spark):
    """3,000 texts around one template, similar to each other by 0.74, and 40 links of 0.77 among them."""
    template = [f"t{i}" for i in range(89)]
    rows = [(i, " ".join(template + [f"o{i}x{k}" for k in range(15)])) for i in range(3000)]
    for i in range(40):
        rows.append((5000 + i, " ".join(template + [f"o{70 * i}x{k}" for k in range(2)] + [f"p{i}x{k}" for k in range(13)])))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id <> component_id").collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(5000 + i, 70 * i) for i in range(40)]


def test_odd_rows(spark, odd_docs):
    found = near_duplicates(odd_docs).collect()
    assert len(found) == len(TEXTS)
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert by_id[2] == (6, 1) and by_id[3] == (0, 3) and by_id[4] == (0, 4) and by_id[None][1] is None
    kept = drop_near_duplicates(odd_docs)
    assert kept.schema.names == odd_docs.schema.names
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-8, 1, 3, 4, 5, 6, 7, 9]
    assert kept.filter("doc_id IS NULL").count() == 1


def test_no_rows(no_docs):
    assert near_duplicates(no_docs).collect() == []
    assert drop_near_duplicates(no_docs).collect() == []


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, j) for j in range(101, 140)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    label = {n: n for pair in links for n in pair}
    for _ in range(100):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: label[n] for n in linked}


def test_shingles_of_bytes():
    import numpy as np

    texts = ["A b  c\td e f", "a b c d e f", "x", "", " \x0b ", "é É e f g h i"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    with np.errstate(over="ignore"):
        sets = shingle_sets(np.frombuffer(data, np.uint8), offsets)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts] and (sets[0] == sets[1]).all()


@pytest.mark.parametrize("members, pairs, dense", [(5, 10, 0), (6, 5, 6), (300, 299, 300)])
def test_dense_regions_give_one_pair_per_member(members, pairs, dense):
    """The others of its pairs are the exact join's, which all members reach."""
    nodes = [b"%016d" % i for i in range(members)]
    rows = [[bytes(1 + 4 * KEY_VALUES)] * members, nodes, nodes, [None] * members]
    batch = pa.record_batch([pa.array(c, pa.binary()) for c in rows], names=_PLANTED)
    found = [row for out in _neighbours(iter([batch.slice(0, members // 2), batch.slice(members // 2)]), DEPTH, True) for row in out.to_pylist()]
    marked = {row["a"] for row in found if row["dense"]}
    assert len({(row["a"], row["b"]) for row in found if row["b"]}) == pairs
    assert len(marked) == dense


def test_components_end_with_stars(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(components, "saved", lambda df, purpose, saved=components.saved: rounds.append(purpose) or saved(df, purpose))
    links = spark.createDataFrame([(2, 1), (1, 3), (5, 4), (3, 3)], "a long, b long")
    found = dict(map(tuple, connected_components(links).collect()))
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    assert rounds.count("small-star") == 1


def test_batches_are_bounded(spark, odd_docs):
    spark.conf.unset(BATCH_BYTES)
    try:
        found = near_duplicates(odd_docs)
        assert spark.conf.get(BATCH_BYTES) == f"{4 << 20}b"
        assert found.count() == len(TEXTS)
    finally:
        spark.conf.unset(BATCH_BYTES)
