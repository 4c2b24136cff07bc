"""Tiled exact similarity equals brute force, for any tile size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.operators import identity as ID
from tests.conftest import SF_ORACLE
from sightline.sources.tables import vectors


@pytest.fixture(scope="module")
def vecs(spark):
    return vectors(spark, SF_ORACLE).cache()


def _brute(vs):
    ids = np.array([r.vec_id for r in vs])
    cams = np.array([r.camera_id for r in vs])
    m = np.array([np.asarray(r.embedding, dtype=np.float64) for r in vs])
    m = m / np.linalg.norm(m, axis=1)[:, None]
    return ids, cams, m @ m.T


def test_pairs_any_tile_size(spark, vecs):
    ids, cams, s = _brute(vecs.collect())
    want = {(min(ids[i], ids[j]), max(ids[i], ids[j])) for i in range(len(ids)) for j in range(len(ids))
            if i < j and cams[i] != cams[j] and s[i, j] > 0.3}
    for tile in (37, 4096):
        got = {(r.vec_id_a, r.vec_id_b) for r in
               ID.similar_pairs(vecs, "vec_id", "embedding", "camera_id", 0.3, tile_size=tile).collect()}
        assert got == want


def test_topk_any_tile_size(spark, vecs):
    ids, _, s = _brute(vecs.collect())
    np.fill_diagonal(s, -np.inf)
    want = {}
    for i, q in enumerate(ids):
        order = np.lexsort((ids, -np.round(s[i], 9)))[:5]
        want[q] = list(ids[order])
    for tile in (29, 4096):
        got = {}
        for r in ID.top_k(vecs, "vec_id", "embedding", 5, tile_size=tile).orderBy("vec_id", "rank").collect():
            got.setdefault(r.vec_id, []).append(r.nbr_id)
        assert got == want


def test_topk_for_query_vectors(spark, vecs):
    q = vecs.where(F.col("vec_id") < 3).withColumn("vec_id", F.col("vec_id") + 100000)
    got = ID.top_k(vecs, "vec_id", "embedding", 1, tile_size=50, queries=q).collect()
    # a query identical to vector v finds v itself first
    assert {r.vec_id - 100000: r.nbr_id for r in got} == {0: 0, 1: 1, 2: 2}


def test_normalise_unit_length(spark, vecs):
    n = vecs.select(ID.l2_norm(ID.normalise(F.col("embedding"))).alias("n")).collect()
    assert all(abs(r.n - 1.0) < 1e-9 for r in n)


def test_search_is_the_same_with_and_without_tiles(spark):
    import numpy as np

    from sightline.operators.identity import search
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(8).round(2)]) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(5)]          # ties
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = v.where("vec_id % 10 = 0")
    a = search(v.repartition(5), "vec_id", "embedding", q, 4)
    b = search(v, "vec_id", "embedding", q, 4, most_queries=3, tile_size=40)
    pick = lambda d: sorted((r.vec_id, r["rank"], r.nbr_id, round(r.sim, 9)) for r in d.collect())
    assert pick(a) == pick(b)
    x = {i: np.array(e) / np.linalg.norm(e) for i, e in rows}
    want = []
    for i, _ in rows:
        if i % 10 == 0:
            best = sorted((-round(float(x[i] @ x[j]), 9), j) for j in x if j != i)[:4]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert [w[:3] for w in pick(a)] == [w[:3] for w in sorted(want)]


def test_search_leaves_k_neighbours_of_repeated_ids(spark):
    """Ids that occur three times with almost the same vector, so the own
    ones are the nearest."""
    rng = np.random.default_rng(4)
    near = rng.standard_normal((30, 6))
    rows = [(i // 3, [float(x) for x in near[i // 3] + 0.001 * rng.standard_normal(6)]) for i in range(90)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = spark.createDataFrame(rows[::15], v.schema)
    few = ID.search(v.repartition(4), "vec_id", "embedding", q, 4).collect()
    tiles = ID.search(v, "vec_id", "embedding", q, 4, most_queries=2, tile_size=25).collect()
    x = np.array([e for _, e in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = []
    for r in q.collect():
        s = x @ (np.array(r.embedding) / np.linalg.norm(r.embedding))
        best = sorted((-round(float(s[j]), 9), i) for j, (i, _) in enumerate(rows) if i != r.vec_id)[:4]
        want += [(r.vec_id, n + 1, i, -c) for n, (c, i) in enumerate(best)]
    for got in (few, tiles):
        assert sorted((r.vec_id, r["rank"], r.nbr_id, round(r.sim, 9)) for r in got) == sorted(want)
