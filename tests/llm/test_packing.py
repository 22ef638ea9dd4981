import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from rejoinder.llm.packing import candidate_cuts, pack_documents, shortest_path
from tests.llm.conftest import TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, rows, capacity):
    """Every id lies in one piece, every sequence is filled from 0 without a gap."""
    wanted = {}
    for key, text in rows:
        wanted.setdefault(key, []).append(np.array(ids_of(text), "<u4"))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert any(
            p.doc_tokens == len(w) and zlib.crc32(w[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for w in wanted[p.doc_id]
        )
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert by_doc.keys() == wanted.keys()
    for key, spans in by_doc.items():
        copies = len(wanted[key])
        assert sum(n for _, n in spans) == sum(map(len, wanted[key]))
        at = 0
        for start, group in itertools.groupby(sorted(spans), key=lambda s: s[0]):
            group = list(group)
            assert start == at and len(group) == copies and len(set(group)) == 1
            at += group[0][1]
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity


def test_every_id_in_one_piece(spark, odd_docs):
    check(pack_documents(odd_docs, PATH).collect(), TEXTS, 4096)


def test_small_sequences_and_stretches(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the cat.", "a dog", "it is!", "zebra"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    pieces = pack_documents(docs, PATH, capacity=32, stretch=200).collect()
    check(pieces, rows, 32)


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = pack_documents(docs, PATH).collect()
    filled = {}
    for p in pieces:
        filled[p.sequence_id] = filled.get(p.sequence_id, 0) + p.length
    padding = sum(4096 - n for n in filled.values() if n & (n - 1))
    assert padding < 0.02 * sum(filled.values())


def test_path_is_the_cheapest():
    rng = random.Random(1)
    for _ in range(50):
        steps = [rng.randint(1, 9) for _ in range(rng.randint(1, 12))]
        places = np.concatenate([[0], np.cumsum(steps)])
        costs = np.array([0] + [rng.choice((0, 3, 20)) for _ in steps])
        best = {0: 0}
        for j in range(1, len(places)):
            best[j] = min(
                best[i] + 10 - (places[j] - places[i]) + costs[j] for i in range(j) if places[j] - places[i] <= 10
            )
        path = shortest_path(places, costs, 10)
        spent = sum(10 - (b - a) for a, b in zip([0, *path], path)) + sum(costs[list(places).index(p)] for p in path)
        assert path[-1] == places[-1] and spent == best[len(places) - 1]


def test_power_of_two_needs_no_padding():
    places = np.array([0, 256, 300, 1024])
    assert shortest_path(places, np.array([0, 4, 4, 0]), 800) == [256, 1024]


def test_long_stretches_get_cuts():
    cuts, costs = candidate_cuts(np.zeros(0, np.int64), np.array([1000]))
    assert cuts.tolist() == [256, 512, 768, 1000] and costs[-1] == 0 and np.diff(cuts, prepend=0).max() <= 256


def test_no_rows(no_docs):
    assert pack_documents(no_docs, PATH).collect() == []
