"""Neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from sightline.llm import ann
from tests.conftest import SF_SMALL


def exact(rows, queries, k=5):
    x = {i: np.array(v, dtype=float) for i, v in rows}
    out = {}
    for q in queries:
        s = [(-float((x[q] * v).sum() / (np.sqrt((x[q] ** 2).sum()) * np.sqrt((v ** 2).sum()))), i)
             for i, v in x.items() if i != q]
        out[q] = sorted(s)[:k]
    return out


def test_recall_and_scores(spark):
    e = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    want = exact(rows, [i for i, _ in rows if i % 50 == 0])
    found = ann.nearest(e, F.col("vec_id") % 50 == 0, block=500, query_block=16)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    x = dict(rows)
    hits = 0
    for q, r in got.items():
        r.sort()
        assert [a for a, _, _ in r] == [1, 2, 3, 4, 5]
        assert all(r[i][2] >= r[i + 1][2] for i in range(4))
        hits += len({i for _, i, _ in r} & {i for _, i in want[q]})
        for _, i, s in r:
            a, b = np.array(x[q], float), np.array(x[i], float)
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
    assert hits / (5 * len(want)) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 1.0]),
            (6, [inf, 1.0, 0.0]), (7, [1.0, None, 0.0]), (None, [1.0, 0.0, 0.0]), (8, [0.0, 1.0, 0.0]),
            (9, [1.0, 0.0]), (50, [1.0, 0.0, 0.0]), (50, [1.0, 0.0, 0.0]), (100, [1e300, 0.0, 1e300]),
            (150, [1e-300, 0.0, 0.0]), (200, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS id", "1 AS score", "2 AS dim")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0, k=3, share=10.0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    assert {q: sorted(v) for q, v in got.items()} == {
        0: [(1, 1, 1.0), (2, 50, 1.0), (3, 50, 1.0)],
        50: [(1, 0, 1.0), (2, 1, 1.0), (3, 150, 1.0)],
        100: [(1, 0, round(2 ** -0.5, 9)), (2, 1, round(2 ** -0.5, 9)), (3, 50, round(2 ** -0.5, 9))],
        150: [(1, 0, 1.0), (2, 1, 1.0), (3, 50, 1.0)]}
    assert ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_forest_descends_to_the_longest_prefix():
    s = np.array([[0b0000], [0b0111], [0b0110], [0b1111], [0b0110]], dtype=np.int64)
    f = ann.Forest(s, 4)
    q = np.array([[0b0110]], dtype=np.int64)
    assert [x.tolist() for _, x in f.candidates(q, 1)] == [[2, 4]]
    assert [x.tolist() for _, x in f.candidates(q, 3)] == [[1, 2, 4]]
    assert [x.tolist() for _, x in f.candidates(q, 4)] == [[0, 1, 2, 4]]
    assert [x.tolist() for _, x in f.candidates(q, 99)] == [[0, 1, 2, 3, 4]]
