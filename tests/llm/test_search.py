"""Vector searches against brute force."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from laminar.llm import queries
from laminar.llm.common import table
from laminar.llm.curves import nearest
from laminar.llm.hilbert import hilbert_keys
from laminar.llm import vafile
from laminar.llm.vafile import LONG, Candidates, approximate, bounds, products, top_k
from tests.conftest import SF_SMALL

VECTORS = "vec_id long, embedding array<float>, score string, rank string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], VECTORS)


ODD = [(0, [0.5, 0.25]), (100, [0.5, 0.25]), (1, None), (2, []), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
       (5, [None, 1.0]), (6, [0.0, 0.0]), (7, [0.5, 0.25]), (8, [-0.5, -0.25]), (9, [0.25, 0.5]), (9, [0.25, 0.5]),
       (10, [1.0, 2.0, 3.0]), (200, [1.0, 2.0, 3.0])]


def brute_products(rows, k, every=100):
    whole = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
             if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {i: v for i, v in whole if i % every == 0}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_exact_top_k(spark):
    got = top_k(vectors(spark, ODD), F.col("vec_id") % 100 == 0, k=4)
    assert sorted(map(tuple, got.collect())) == brute_products(ODD, 4)
    assert top_k(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").collect()]
    assert sorted(map(tuple, queries.op10_exact_top_k(spark, SF_SMALL).collect())) == brute_products(rows, 10)


def test_huge_components_stay_exact(spark):
    rows = [(100 * i, [float(10 ** (2 + i)), -1.0]) for i in range(5)]
    got = top_k(vectors(spark, rows), F.col("vec_id") % 100 == 0, k=2)
    assert sorted(map(tuple, got.collect())) == brute_products(rows, 2)


def test_bounds_hold_and_blocks_change_nothing():
    rng = np.random.default_rng(6)
    for top in (50, 10**6, 2**40, 2**61):
        v, q = rng.integers(-top, top, (300, 7)), rng.integers(-top, top, (30, 7))
        cell, low, shift = approximate(v)
        assert int(cell.max()) < 64
        lower, upper = bounds(q, cell, low, shift)
        exact = q.astype(object) @ v.astype(object).T
        assert (lower <= exact).all() and (exact <= upper).all()
        assert products(q, v[:30]).tolist() == [min(LONG, max(-LONG, int(exact[i, i]))) for i in range(30)]
        ids, kept = np.arange(300), []
        for size in (300, 37):
            mine = Candidates(ids[::10], q, 5)
            for i in range(0, 300, size):
                mine.add(ids[i: i + size], *bounds(q, *approximate(v[i: i + size])))
            kept.append({(a, b) for a, b in zip(*(x.tolist() for x in mine.rows()[:2]))})
        want = {(10 * r, i) for r in range(30) for _, i in sorted((-int(exact[r, i]), i) for i in range(300) if i != 10 * r)[:5]}
        assert want <= kept[0] and want <= kept[1]


def test_many_dimensions_cost_a_few_products():
    rng = np.random.default_rng(1)
    v, q = rng.integers(-1024, 1024, (2048, 768)), rng.integers(-1024, 1024, (400, 768))
    file = approximate(v)

    def least(f):
        took = []
        for _ in range(5):
            t = time.perf_counter()
            f()
            took.append(time.perf_counter() - t)
        return min(took)

    mine = Candidates(np.arange(400) + 5000, q, 10)
    assert least(lambda: mine.add(np.arange(2048), *bounds(q, *file))) < 5 * least(lambda: q.astype(float) @ v.astype(float).T) + 0.05


def test_query_blocks_and_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(vafile, "QUERY_BLOCK", 3)
    monkeypatch.setattr(vafile, "QUERY_BLOCKS", 2)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=200) * (1 + i % 3)).tolist()) for i in range(150)]
    got = top_k(vectors(spark, rows), F.col("vec_id") % 5 == 0, k=4)
    assert sorted(map(tuple, got.collect())) == brute_products(rows, 4, 5)


def test_hilbert_keys_step_to_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    walk = grid[np.argsort(hilbert_keys(grid, 3))]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()
    with pytest.raises(ValueError):
        hilbert_keys(grid, 40)


def brute_cosine(rows, k, every):
    fine = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in fine:
        if q % every == 0:
            s = sorted({(-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 12), i) for i, b in fine
                        if i != q and len(a) == len(b)})
            out[q] = [(i, -x) for x, i in s[:k]]
    return out


def test_nearest_on_odd_rows(spark):
    got = {}
    for r in nearest(vectors(spark, ODD), F.col("vec_id") % 100 == 0, k=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    assert got == brute_cosine(ODD, 3, 100)
    assert nearest(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0


def test_a_frequent_vector_keeps_its_smallest_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(400)] + [(1000 + i, [float(i % 7), 1.0, float(i % 3), -1.0]) for i in range(100)]
    got = nearest(vectors(spark, rows), F.col("vec_id") == 350, k=5).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 1, 2, 3, 4]


def test_recall_of_the_registered_query(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").collect()]
    want = brute_cosine(rows, 5, 50)
    got = {}
    for r in queries.op5_hilbert_neighbours(spark, SF_SMALL).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = sum(len(set(got[q]) & {i for i, _ in w}) for q, w in want.items())
    assert set(got) == set(want) and all(len(g) == 5 for g in got.values())
    assert hits / sum(map(len, want.values())) >= 0.9
    for q, w in want.items():
        for i, s in w:
            assert i not in got[q] or abs(got[q][i] - s) < 1e-9
