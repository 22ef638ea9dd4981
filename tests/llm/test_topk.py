import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rejoinder.llm import topk
from rejoinder.llm.topk import best_of_group, search


def brute(rows, k):
    usable = [(key, v) for key, v in rows if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    packed = [(key, [math.floor(256 * x) for x in v]) for key, v in usable]
    result = []
    for q in sorted({key for key, _ in packed if key % 50 == 0}):
        asked = [v for key, v in packed if key == q]
        scored = sorted((-sum(a * b for a, b in zip(own, v)), key) for own in asked for key, v in packed if key != q)
        result += [(q, r, key, -s) for r, (s, key) in enumerate(scored[:k], 1)]
    return sorted(result)


@pytest.mark.parametrize("seed", range(3))
def test_like_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.choice((-0.5, 0.0, 0.25, rng.uniform(-2, 2))) for _ in range(6)]) for i in range(700)]
    rows += [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 6), (None, [1.0] * 6), (1150, []), (1200, [0.5]), (50, [9.0] * 6)]
    rows += [(7, [9.0] * 6), (7, [9.0] * 6), (8, [9.0] * 6), (9, [8.0] * 6), (9, [8.5] * 6), (100, [-9.0] * 6), (100, [-9.0] * 6)]
    found = search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == brute(rows, 5)


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>, rank string, part string"
    few = spark.createDataFrame([(0, [1.0], "?", "?"), (7, [2.0], "?", "?")], schema)
    assert [tuple(r) for r in search(few, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 7, 256 * 512)]
    assert search(few.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_blocks_below_the_kth_score_are_passed_over():
    rng = np.random.default_rng(1)
    vectors = np.sort(rng.integers(-300, 300, (1000, 4)), axis=0)
    queries, ids = rng.integers(-300, 300, (20, 4)), np.arange(1000)
    for block in (1, 16, 128):
        found = list(best_of_group(queries, -1 - np.arange(20), vectors, ids, 5, block))
        for q in range(20):
            scores = vectors @ queries[q]
            order = np.lexsort((ids, -scores))[:5]
            assert [(v, s) for i, v, s in found if i == -1 - q] == [(int(i), int(scores[i])) for i in order]


def test_parts_do_not_follow_the_groups(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(topk, "GROUP", 128)
    monkeypatch.setattr(topk, "PARTS", 3, raising=False)
    monkeypatch.setattr(topk, "saved", lambda df, purpose, save=topk.saved: tables.append(save(df, purpose)) or tables[-1])
    rng = random.Random(4)
    rows = [(1 if i % 3 else i, [rng.choice((-0.5, 0.25, rng.uniform(-2, 2))) for _ in range(4)]) for i in range(2000)]
    found = search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == brute(rows, 5)
    parts = {part: n for part, n in tables[0].groupBy("part").agg(F.sum(F.length("ids")) / 8).collect()}
    assert len(parts) == 3 and sum(parts.values()) == 2000 and max(parts.values()) < 1000  # although one id has 1333 rows


@pytest.mark.parametrize("scale", [1, 2**10, 2**20])  # in single and double precision, and in whole numbers
def test_best_rows_go_on_from_group_to_group(scale):
    rng = np.random.default_rng(scale)
    vectors = rng.integers(-3, 4, (600, 4)) * 100 * scale
    ids, queries, query_ids = rng.integers(0, 400, 600), rng.integers(-3, 4, (30, 4)) * 100 * scale, rng.integers(0, 400, 30)
    best = topk._Best(query_ids, queries, 7)
    for a in (400, 0, 200):
        best.meet(vectors[a : a + 200], ids[a : a + 200], 16)
    found = np.stack(best.rows(), axis=1).reshape(30, 7, 3).tolist()
    for q in range(30):
        scored = sorted((-s, i) for s, i in zip((vectors @ queries[q]).tolist(), ids.tolist()) if i != query_ids[q])[:7]
        assert found[q] == [[query_ids[q], i, -s] for s, i in scored]
