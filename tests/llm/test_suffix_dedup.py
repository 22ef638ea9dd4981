import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from rejoinder.llm import suffix_dedup
from rejoinder.llm.suffix_dedup import remove_repeats
from tests.llm.conftest import TEXTS


def brute(texts, length):
    """Removed spans of each text, from the counts of all strings of the length."""
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1])
        found.append(edges.reshape(-1, 2).tolist())
    return found


def check(spark, rows, length):
    found = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), length).collect()
    texts = [(t or "").encode() for _, t in rows]
    wanted = sorted(
        (k is not None, k or 0, t, s, bytes(c for i, c in enumerate(t) if not any(a <= i < b for a, b in s)))
        for (k, _), t, s in zip(rows, texts, brute(texts, length))
    )
    mine = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, [[s.start, s.end] for s in r.spans], bytes(r.kept)) for r in found)
    assert sorted((a, b, len(t), s, k) for a, b, t, s, k in wanted) == mine


@pytest.mark.parametrize("length", [3, 8, 25])
def test_small_alphabet(spark, length):
    rng = random.Random(length)
    rows = [(i, "".join(rng.choices("ab", k=rng.randint(0, 70)))) for i in range(60)]
    check(spark, rows + [(100, "a" * 300), (101, "a" * 20), (None, "ab" * 30)], length)


def test_planted_passages(spark):
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefgh ", k=500))
    rows = [(i, "".join(rng.choices("abcdefgh ", k=900))) for i in range(20)]
    rows += [(20 + i, t[:300] + passage[i : 450 + i] + t[300:]) for i, (_, t) in enumerate(rows[:10])]
    check(spark, rows, 400)


def test_odd_rows(spark, odd_docs):
    found = {r.doc_id: r for r in remove_repeats(odd_docs).collect()}
    assert remove_repeats(odd_docs).count() == len(TEXTS)
    assert bytes(found[9].kept) == b"" and bytes(found[5].kept) == b"Short." and found[4].n_bytes == 0


def test_long_texts_are_cut_into_overlapping_pieces():
    for sizes in ([5, 0, 90, 3, 200], [1000], [], [10] * 50):
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        seen = Counter()
        for begin, end, ends in suffix_dedup.pieces(offsets, 8, 40):
            inside = np.ones(max(0, end - begin - 7), bool)
            for e in ends - begin:
                inside[max(0, e - 7) : e] = False
            seen.update((np.flatnonzero(inside) + begin).tolist())
        wanted = [p for a, b in zip(offsets, offsets[1:]) for p in range(a, b - 7)]
        assert seen == Counter(wanted)


def test_no_rows(no_docs):
    assert remove_repeats(no_docs).collect() == []


def test_ranges_are_those_of_the_upper_bits():
    rng = np.random.default_rng(6)
    for ranges in (1, 3, 64, 1000):
        edges = np.array([-(-(p << 32) // ranges) << 32 for p in range(ranges)], np.uint64)
        hashes = np.concatenate([edges, edges[1:] - np.uint64(1), rng.integers(0, 2**64, 500, np.uint64), edges[:2]])
        known, times = np.unique(hashes, return_counts=True)
        part = ((known >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        found = [suffix_dedup._received(blob) if blob else ([], []) for blob in suffix_dedup._ranges(hashes, ranges)]
        assert [len(h) for h, _ in found] == np.bincount(part.astype(int), minlength=ranges).tolist()
        assert np.concatenate([h for h, _ in found]).tolist() == known.tolist()
        assert np.concatenate([o for _, o in found]).tolist() == (times > 1).tolist()


def test_hashes_of_a_block_that_repeats_are_held_few_times():
    names = np.random.default_rng(7).integers(0, 2**64, 1 << 18, np.uint64)
    sent = [suffix_dedup._received(blob)[0] for blob in suffix_dedup._ranges(names.copy(), 64)]
    block = suffix_dedup._Block.__new__(suffix_dedup._Block)
    block.answers = {(2, p): np.packbits(h % np.uint64(2) == 0).tobytes() for p, h in enumerate(sent)}
    wanted = np.unique(names[names % np.uint64(2) == 0])
    tracemalloc.start()
    found = block.several(names, 2, 64)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.tolist() == wanted.tolist() and most < 3 * names.nbytes


def test_small_partitions_share_blocks(spark, monkeypatch):
    blocks = []
    monkeypatch.setattr(suffix_dedup, "saved", lambda df, purpose, saved=suffix_dedup.saved: blocks.append(saved(df, purpose)) or blocks[-1])
    docs = spark.createDataFrame([(i, f"{i} " + "ab" * 250) for i in range(200)], "doc_id long, text string").repartition(100)
    found = remove_repeats(docs).collect()
    assert len(found) == 200 and all(r.spans for r in found)
    assert blocks[0].count() <= 3 * spark.sparkContext.defaultParallelism < 100
