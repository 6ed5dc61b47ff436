"""Vector search where ids stand in many rows."""

import numpy as np
from pyspark.sql import functions as F

from laminar.llm.curves import _rank, nearest
from tests.llm.test_search import brute_cosine, vectors


def found(spark, rows, k=5):
    got = {}
    for r in nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0, k=k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    return got


def test_repeated_rows_of_an_id_count_once(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(1, same)] * 10 + [(i, same) for i in (2, 3, 4, 5, 6, 7, 100)] + [(8, [1.0, 2.0, 2.5])] * 10 + [(9, [0.0, 1.0, 0.0])]
    assert found(spark, rows) == brute_cosine(rows, 5, 100) == {100: [(i, 1.0) for i in (1, 2, 3, 4, 5)]}


def test_an_id_with_many_vectors_leaves_room_for_others(spark):
    rows = [(100, [1.0, 0.0])] + [(1, [1.0, 0.001 * i]) for i in range(40)] + [(i, [1.0, 0.1 * i]) for i in range(2, 9)]
    want = [1, 2, 3, 4, 5]
    assert [i for i, _ in found(spark, rows)[100]] == want
    v = np.array([x for _, x in rows[1:]])
    v /= np.linalg.norm(v, axis=1)[:, None]
    assert [r[1] for r in _rank(np.array([[1.0, 0.0]]), np.array([100]), v, np.array([i for i, _ in rows[1:]]), 5)] == want
