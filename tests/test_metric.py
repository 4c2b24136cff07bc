import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.operators import identity, metric
from sightline.session import materialize

SCHEMA = "vec_id long, camera_id string, embedding array<double>"


def clustered(n, groups, dim=16, spread=0.08, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return [(i, f"cam{i % 3}", (centres[i % groups] + rng.normal(scale=spread, size=dim)).tolist()) for i in range(n)]


def scattered(n, dim=16, seed=4):
    return [(i, f"cam{i % 3}", v.tolist()) for i, v in enumerate(np.random.default_rng(seed).normal(size=(n, dim)))]


ODD = [(900, "cam1", None), (901, "cam1", []), (902, "cam1", [0.0] * 16), (903, "cam1", [float("nan")] + [1.0] * 15),
       (904, "cam1", [float("inf")] + [1.0] * 15), (905, "cam1", [None] + [1.0] * 15), (906, "cam1", [1.0, 2.0]),
       (None, "cam1", [1.0] * 16)]


def cosines(rows):
    x = np.array([v for _, _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x @ x.T


def brute_pairs(rows, t):
    s = cosines(rows)
    return sorted((a[0], b[0]) for i, a in enumerate(rows) for j, b in enumerate(rows)
                  if a[0] < b[0] and a[1] != b[1] and s[i, j] > t)


def brute_nearest(rows, ids, k):
    s, at = cosines(rows), {r[0]: i for i, r in enumerate(rows)}
    return sorted((q, n + 1, rows[j][0]) for q in ids
                  for n, j in enumerate(sorted((j for j in range(len(rows)) if rows[j][0] != q),
                                               key=lambda j: (-round(s[at[q], j], 9), rows[j][0]))[:k]))


@pytest.mark.parametrize("rows,t", [(clustered(400, 20), 0.8), (scattered(250), 0.3), (scattered(120), -0.2)])
def test_pairs(spark, rows, t):
    df = spark.createDataFrame(rows + ODD, SCHEMA)
    got = metric.near_pairs(df, "vec_id", "embedding", "camera_id", t, tile_size=40)
    pairs = [(r.vec_id_a, r.vec_id_b) for r in got.collect()]
    assert sorted(pairs) == brute_pairs(rows, t)           # each once
    assert got.columns == ["vec_id_a", "vec_id_b", "camera_id_a", "camera_id_b", "sim"]


def test_copies_of_one_vector_are_cut_into_tiles(spark):
    """A third of all rows are one vector: its cell is cut, nothing is lost."""
    rows = clustered(120, 8) + [(1000 + i, f"cam{i % 2}", [1.0] * 16) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = metric.near_pairs(df, "vec_id", "embedding", "camera_id", 0.9, tile_size=16)
    assert sorted((r.vec_id_a, r.vec_id_b) for r in got.collect()) == brute_pairs(rows, 0.9)


def test_copies_stay_below_tiles_on_clusters(spark):
    tile, rows = 50, clustered(1000, 40)
    v = spark.createDataFrame(rows, SCHEMA).select(F.col("vec_id").alias("_id"), F.col("embedding").alias("_v"))
    pivots = metric.choose_pivots(v, 40)
    groups = metric.near_groups(materialize(metric.place(v, pivots)), pivots, math.acos(0.8), tile)
    copies = groups.groupBy("_id").count()
    tiles = len(rows) / tile
    assert copies.agg(F.avg("count")).first()[0] < tiles / 4
    sizes = groups.groupBy("_cell", "_g_lo", "_g_hi").count().agg(F.max("count")).first()[0]
    assert sizes < 4 * tile


@pytest.mark.parametrize("rows", [clustered(600, 25), scattered(200)])
def test_index_equals_full_search(spark, tmp_dir, rows):
    df = spark.createDataFrame(rows + ODD, SCHEMA)
    metric.build_index(df, "vec_id", "embedding", f"{tmp_dir}/index", pivots=25)
    asked = [r[0] for r in rows if r[0] % 20 == 0]
    queries = df.where((F.col("vec_id") % 20 == 0) | F.col("vec_id").isNull())
    seen = []
    got = metric.search_index(f"{tmp_dir}/index", queries, "vec_id", "embedding", 5, block=64, report=seen)
    want = brute_nearest(rows, asked, 5)
    assert sorted((r.vec_id, r.rank, r.nbr_id) for r in got.collect()) == want
    assert seen[-1][1] == 0                                  # nothing left to read
    full = identity.search(df, "vec_id", "embedding", queries, 5)
    assert sorted((r.vec_id, r.rank, r.nbr_id) for r in full.collect()) == want
    tiled = identity.search(df, "vec_id", "embedding", queries, 5, most_queries=3, tile_size=100)
    assert sorted((r.vec_id, r.rank, r.nbr_id) for r in tiled.collect()) == want


def test_index_reads_few_shells_on_clusters_and_most_on_noise(spark, tmp_dir):
    read = {}
    for name, rows in (("clusters", clustered(900, 30)), ("noise", scattered(900))):
        df = spark.createDataFrame(rows, SCHEMA)
        metric.build_index(df, "vec_id", "embedding", f"{tmp_dir}/{name}", pivots=30)
        seen = []
        metric.search_index(f"{tmp_dir}/{name}", df.where("vec_id = 60"), "vec_id", "embedding", 5, report=seen)
        read[name] = sum(n for _, n, _ in seen) / seen[0][2]
    assert read["clusters"] < 0.3 < read["noise"]


def test_fewer_rows_than_k_and_empty(spark, tmp_dir):
    two = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "b", [0.0, 1.0])], SCHEMA)
    metric.build_index(two, "vec_id", "embedding", f"{tmp_dir}/two")
    got = metric.search_index(f"{tmp_dir}/two", two, "vec_id", "embedding", 5)
    assert sorted((r.vec_id, r.rank, r.nbr_id) for r in got.collect()) == [(1, 1, 2), (2, 1, 1)]
    none = two.limit(0)
    metric.build_index(none, "vec_id", "embedding", f"{tmp_dir}/none")
    assert metric.search_index(f"{tmp_dir}/none", two, "vec_id", "embedding", 5).count() == 0
    assert metric.near_pairs(none, "vec_id", "embedding", None, 0.5).count() == 0
    assert identity.search(none, "vec_id", "embedding", two, 3).count() == 0
    assert identity.top_k(none, "vec_id", "embedding", 3).count() == 0


def test_odd_vectors_take_no_part(spark):
    rows = scattered(30)
    df = spark.createDataFrame(rows + ODD, SCHEMA)
    got = identity.top_k(df, "vec_id", "embedding", 2, tile_size=8)
    assert sorted((r.vec_id, r.rank, r.nbr_id) for r in got.collect()) == brute_nearest(rows, range(30), 2)


def test_vectors_are_not_copied_for_their_pairs(spark):
    """Blocks are dealt to a fixed number of parts: no groups with copies
    for every cell or tile, and no cross join."""
    df = spark.createDataFrame(scattered(200) + ODD, SCHEMA)
    pairs = metric.near_pairs(df, "vec_id", "embedding", "camera_id", 0.3, tile_size=20)
    plan = pairs._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "FlatMapGroupsInPandas" not in plan
    nearest = identity.top_k(df, "vec_id", "embedding", 3, tile_size=20)
    plan = nearest._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "FlatMapGroupsInPandas" not in plan


def test_pairs_carry_columns_of_both_ends(spark):
    rows = clustered(90, 9)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("seen", F.col("vec_id") * 10)
    got = metric.near_pairs(df, "vec_id", "embedding", "camera_id", 0.8, tile_size=20, carry=("seen",)).collect()
    assert sorted((r.vec_id_a, r.vec_id_b) for r in got) == brute_pairs(rows, 0.8)
    assert all(r.seen_a == 10 * r.vec_id_a and r.seen_b == 10 * r.vec_id_b for r in got)


def test_best_so_far_takes_little_of_a_block():
    """The k best over blocks equal those of all rows at once, ties by id."""
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(7, 4)).round(1), rng.normal(size=(90, 4)).round(1)
    y[60:] = y[:30]
    best = None
    for at in range(0, 90, 20):
        best = identity._better(best, x, np.arange(1000, 1007), y[at:at + 20], np.arange(90)[at:at + 20], 5)
    s = x @ y.T
    want = [(i, j) for i in range(7) for j in sorted(range(90), key=lambda j: (-round(s[i, j], 9), j))[:5]]
    assert list(zip(best["at"], best["n"])) == want
