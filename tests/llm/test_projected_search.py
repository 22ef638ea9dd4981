import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rejoinder.llm import projected_search
from rejoinder.llm.projected_search import Block, Projection, box_distances, cell_of, chi_square_quantile, fit_cells, search
from tests.conftest import TESTDATA

SCHEMA = "vec_id long, embedding array<double>, key string, cell string, id string"


def brute(rows, k, every):
    usable = []
    for key, v in rows:
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable.append((key, np.array([*v, *[0.0] * (6 - len(v))])))
    found = []
    for query, q in {(key, tuple(v)) for key, v in usable if key % every == 0}:
        scored = sorted((-float((np.array(q) * v).sum()), key) for key, v in usable if key != query)[:k]
        found += [(query, r, key, -score) for r, (score, key) in enumerate(scored, 1)]
    return sorted(found)


def run(spark, rows, every=20, **options):
    given = spark.createDataFrame([(*r, "?", "?", "?") for r in rows], SCHEMA)
    found = search(given, F.col("vec_id") % every == 0, **options)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("seed,block,chunk", [(0, 4096, 256), (1, 40, 7), (2, 15, 1)])
def test_like_brute_force_when_nothing_may_be_missed(spark, seed, block, chunk):
    rng = random.Random(seed)
    rows = [(i, [rng.choice((-0.5, 0.0, 0.25, rng.uniform(-2, 2))) for _ in range(6)]) for i in range(400)]
    rows += [(1000, None), (1020, [1.0, None]), (1040, [float("nan")] * 6), (None, [1.0] * 6), (1060, []), (1080, [0.5]), (1100, [0.0] * 6)]
    rows += [(1120, [-0.0, 0.5]), (1121, [0.0, 0.5, 0.0])] + [(i, [1.0, 2.0, 0.5]) for i in range(2000, 2090)] + [(2000, [1.0, 2.0, 0.5])] * 3
    rows += [(3000, [float("inf")] * 6), (3020, [1e-3])]
    rng.shuffle(rows)
    assert run(spark, rows, confidence=1 - 1e-12, block=block, chunk=chunk, sample=100) == brute(rows, 20, 20)


def test_few_and_no_rows(spark):
    assert run(spark, [(0, [1.0]), (7, [2.0])]) == [(0, 1, 7, 2.0)]
    assert run(spark, [(0, [1.0])]) == run(spark, [(1, [1.0]), (2, [2.0])]) == run(spark, []) == []


@pytest.mark.parametrize("block", [4096, 100])
def test_recall(spark, block):
    vectors = spark.read.parquet(f"{TESTDATA}/sf0.1/embeddings.parquet")
    held = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    ids, matrix = np.array(list(held)), np.array(list(held.values()))
    found = {}
    for r in search(vectors, F.col("vec_id") % 20 == 0, block=block).collect():
        found.setdefault(r.query_id, {})[r.vec_id] = r.score
    seen = 0
    for q in ids[ids % 20 == 0].tolist():
        scores = matrix @ held[q]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        seen += len({int(ids[i]) for i in order} & found[q].keys())
        assert len(found[q]) == 20 and all(math.isclose(s, float(held[v] @ held[q]), rel_tol=1e-12) for v, s in found[q].items())
    assert seen >= 0.9 * 20 * len(found) and len(found) == 100


def test_chi_square():
    rng = np.random.default_rng(3)
    squares = (rng.standard_normal((200_000, 16)) ** 2).sum(axis=1)
    for p in (0.5, 0.9, 0.99):
        assert abs((squares <= chi_square_quantile(16, p)).mean() - p) < 5e-3


def test_search_stops_early_on_clusters():
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((100, 32))
    vectors = np.repeat(centers, 20, axis=0) + 0.05 * rng.standard_normal((2000, 32))
    projection = Projection(32, float(np.sqrt((vectors**2).sum(axis=1).max())))
    block = Block(vectors, [[i] for i in range(2000)], [[1]] * 2000, projection)
    queries = vectors[::20]
    found, verified = block.nearest(queries, np.full(len(queries), np.inf), 10, chi_square_quantile(projected_search.DIMENSIONS, projected_search.CONFIDENCE))
    hits = [len({row for _, row in best} & set(np.argsort(-(vectors @ q))[:10].tolist())) for q, best in zip(queries, found)]
    assert sum(hits) >= 0.9 * 10 * len(queries) and verified < 0.6 * len(queries) * len(vectors)


def test_cells_cover_all_points():
    rng = np.random.default_rng(6)
    points = rng.integers(0, 3, (500, 16)).astype(float)
    splits = fit_cells(points[:100], 16)
    cells = cell_of(points, splits)
    assert cells.min() >= 0 and cells.max() < 16 and len(set(cells.tolist())) > 8
    low, high = points.min(axis=0)[None], points.max(axis=0)[None]
    assert (box_distances(points, low, high) == 0).all() and box_distances(points[:1] + 5, low, high)[0, 0] > 0
    assert (cell_of(points, fit_cells(np.ones((50, 16)), 8)) == cell_of(points[:1], fit_cells(np.ones((50, 16)), 8))).any()
