"""Bucketed sequence helpers and the as-of join equal their plain forms."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sightline.operators.graph import connected_components
from sightline.operators.matching import asof_join, time_gate_pairs
from sightline.operators.sequence import running_total, with_neighbor


def _data(spark, n=400, keys=3, seed=1):
    rnd = random.Random(seed)
    rows = [(f"k{rnd.randrange(keys)}", i, rnd.randrange(1000), rnd.randint(0, 5)) for i in range(n)]
    return spark.createDataFrame(rows, "k string, id long, t long, v long")


def test_running_total_matches_window(spark):
    df = _data(spark)
    got = running_total(df, ["k"], ["t", "id"], F.floor(F.col("t") / 37), F.col("v"), "run")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("run", F.sum("v").over(w))
    assert sorted(got.select("id", "run").collect()) == sorted(want.select("id", "run").collect())


def test_neighbors_match_lag_lead(spark):
    df = _data(spark, seed=2)
    w = Window.partitionBy("k").orderBy("t", "id")
    bucket = F.floor(F.col("t") / 53)
    for direction, fn in (("prev", F.lag), ("next", F.lead)):
        got = with_neighbor(df, ["k"], ["t", "id"], bucket, ["id"], direction)
        want = df.withColumn(direction + "_id", fn("id").over(w))
        assert sorted(got.select("id", direction + "_id").collect()) == \
            sorted(want.select("id", direction + "_id").collect())


def test_asof_across_buckets_and_ties(spark):
    rnd = random.Random(5)
    right = [(f"g{rnd.randrange(4)}", i, rnd.randrange(500)) for i in range(150)]
    left = [(f"g{rnd.randrange(4)}", 1000 + i, rnd.randrange(500)) for i in range(150)]
    # equal timestamps on the right: the higher offset must win
    right += [("g0", 5000, 250), ("g0", 5001, 250)]
    left += [("g0", 6000, 250)]
    R = spark.createDataFrame(right, "g string, off long, t long").withColumn(
        "ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    L = spark.createDataFrame(left, "g string, lid long, t long").withColumn(
        "ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    got = asof_join(L.select("g", "lid", "ts"), R.select("g", "off", "ts"), ["g"], "ts", [],
                    tie="off", bucket=F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 40))
    got = {r.lid: r.match_off for r in got.collect()}
    for g, lid, t in left:
        cands = [(rt, off) for rg, off, rt in right if rg == g and rt <= t]
        want = max(cands)[1] if cands else None
        assert got[lid] == want, (lid, got[lid], want)
    assert got[6000] == 5001


def test_time_gate_pairs_complete(spark):
    rnd = random.Random(9)
    rows = [(f"p{rnd.randrange(5)}", i, rnd.randrange(100000)) for i in range(300)]
    df = spark.createDataFrame(rows, "who string, eid long, t long").withColumn(
        "ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    got = {(r.a_eid, r.b_eid) for r in time_gate_pairs(df, "who", "ts", 3600, ["eid"]).collect()}
    want = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and 0 < b[2] - a[2] <= 3600}
    assert got == want


def test_components_are_order_independent(spark):
    rnd = random.Random(11)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    verts = sorted({v for e in edges for v in e} | set(range(200, 205)))
    labels = []
    for order in (edges, list(reversed(edges)), [(b, a) for a, b in edges]):
        e = spark.createDataFrame(order, "src long, dst long")
        v = spark.createDataFrame([(x,) for x in verts], "id long")
        labels.append({r.id: r.component for r in connected_components(v, e).collect()})
    assert labels[0] == labels[1] == labels[2]
    # brute-force union-find
    parent = {v: v for v in verts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    groups = {}
    for v in verts:
        groups.setdefault(find(v), []).append(v)
    want = {v: min(g) for g in groups.values() for v in g}
    assert labels[0] == want
    assert labels[0][140] == 100            # a 40-hop chain converges


def test_components_need_logarithmic_rounds(spark):
    """Descending, random-id and star graphs of 2,000 vertices: every label
    is the least member and the rounds are logarithmic in the size."""
    import math

    from sightline.operators.graph import component_labels
    n = 2000
    rnd = random.Random(5)
    ids = rnd.sample(range(10 * n), n)
    shapes = {"descending": [(0, n - 1)] + [(i, i - 1) for i in range(n - 1, 1, -1)],
              "random ids": list(zip(ids, ids[1:])),
              "star": [(n // 2, i) for i in range(n) if i != n // 2]}
    for what, edges in shapes.items():
        rounds: list[int] = []
        lab = component_labels(spark.createDataFrame(edges, "src long, dst long"), rounds=rounds).collect()
        low = min(v for e in edges for v in e)
        assert len(lab) == n and {r.component for r in lab} == {low}, what
        assert len(rounds) <= math.log2(n) + 2, (what, rounds)
        assert all(b < a for a, b in zip(rounds, rounds[1:])), (what, rounds)


def test_components_of_text_ids_nulls_and_loops(spark):
    from sightline.operators.graph import component_labels
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "x"), (None, "q"), ("y", "z"), ("y", "z")],
                              "src string, dst string")
    assert {(r.v, r.component) for r in component_labels(e).collect()} == {
        ("a", "a"), ("b", "a"), ("c", "a"), ("y", "y"), ("z", "y")}
    assert component_labels(e.limit(0)).collect() == []


def test_sessions_equal_session_window(spark):
    from sightline.operators.crowd import sessions
    from sightline.sources.tables import sightings
    from tests.conftest import SF_ORACLE
    s = sightings(spark, SF_ORACLE).select("event_id", "global_id", "ts")
    got = sorted((r.global_id, r.session_start, r.session_end, r.n_sightings)
                 for r in sessions(s, "global_id", 1800).collect())
    sw = (s.withColumn("ts", F.col("ts").cast("timestamp"))
          .groupBy("global_id", F.session_window("ts", "30 minutes").alias("w"))
          .agg(F.count(F.lit(1)).alias("n")))
    want = sorted((r.global_id, r.start, r.end, r.n) for r in
                  sw.select("global_id", F.col("w.start").cast("timestamp_ntz").alias("start"),
                            F.col("w.end").cast("timestamp_ntz").alias("end"), "n").collect())
    assert got == want


def test_approximate_people_within_error(spark):
    from sightline.operators.crowd import people_per_window
    from sightline.sources.tables import sightings
    from tests.conftest import SF_ORACLE
    s = sightings(spark, SF_ORACLE).select("camera_id", "ts", "global_id")
    exact = {(r.camera_id, r.window_start): r.n_people for r in people_per_window(s, "1 day").collect()}
    approx = {(r.camera_id, r.window_start): r.n_people for r in
              people_per_window(s, "1 day", exact=False).collect()}
    assert exact.keys() == approx.keys()
    # HyperLogLog++ default relative standard deviation is 5 %; allow 4 sigma
    assert all(abs(approx[k] - exact[k]) <= max(1, 0.2 * exact[k]) for k in exact)


def test_chain_heads_on_long_chains(spark):
    from sightline.operators.graph import chain_heads
    links = [(c * 1000 + i, c * 1000 + i + 1) for c, length in enumerate([1, 2, 7, 40]) for i in range(length)]
    heads = {r.dst: r.head for r in chain_heads(spark.createDataFrame(links, "src long, dst long")).collect()}
    for c, length in enumerate([1, 2, 7, 40]):
        for i in range(1, length + 1):
            assert heads[c * 1000 + i] == c * 1000


def test_null_keys_and_times_keep_their_rows(spark):
    """Every ordered helper equals a plain window on rows with null keys and
    null order columns."""
    from pyspark.sql import Window

    from sightline.operators import stats
    from sightline.operators.sequence import numbered_runs, running_totals, with_neighbor
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([None, *range(60)]), rnd.choice(["x", "y"]), float(i % 7))
            for i in range(200)]
    df = spark.createDataFrame(rows, "i long, k string, t int, c string, v double")
    w = Window.partitionBy("k").orderBy("t", "i")
    bucket = F.floor(F.col("t") / 10)
    got = running_totals(df, ["k"], ["t", "i"], bucket, {"n": None, "s": F.col("v")})
    want = df.select("i", F.row_number().over(w).alias("n"), F.sum("v").over(
        w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    assert sorted((r.i, r.n, r.s) for r in got.collect()) == sorted((r.i, r.n, r.s) for r in want.collect())
    for way, fn in (("prev", F.lag), ("next", F.lead)):
        got = with_neighbor(df, ["k"], ["t", "i"], bucket, ["i", "c"], way)
        want = df.select("i", fn("i").over(w).alias("o"), fn("c").over(w).alias("oc"))
        assert (sorted(((r.i, r[f"{way}_i"], r[f"{way}_c"]) for r in got.collect()), key=repr)
                == sorted(((r.i, r.o, r.oc) for r in want.collect()), key=repr))
    got = numbered_runs(df, ["k"], ["t", "i"], bucket, ["c"], lambda p, c: p["c"] != c["c"], "run")
    x = df.withColumn("b", F.coalesce((F.lag("c").over(w) != F.col("c")).cast("int"), F.lit(1)))
    want = x.select("i", F.sum("b").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    assert sorted((r.i, r.run) for r in got.collect()) == sorted((r.i, r.run) for r in want.collect())
    pct = {r.k: (r.a, r.b) for r in stats.exact_percentiles(df, ["k"], "v", {"a": 0.5, "b": 0.9}).collect()}
    want = {r.k: (r.a, r.b) for r in df.groupBy("k").agg(
        F.percentile("v", 0.5).alias("a"), F.percentile("v", 0.9).alias("b")).collect()}
    assert pct.keys() == want.keys()
    assert all(abs(p - q) < 1e-9 for k in want for p, q in zip(pct[k], want[k]))


def test_asof_keeps_left_rows_with_null_key_or_time(spark):
    import datetime as dt

    from sightline.operators.matching import asof_join, class_name_lookup
    t0 = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, "a", t0), (2, None, t0), (3, "a", None), (4, None, None)],
                                 "i long, k string, ts timestamp_ntz")
    right = spark.createDataFrame([("a", t0, 7), (None, t0, 8), ("a", None, 9)], "k string, ts timestamp_ntz, v long")
    got = {r.i: r.match_v for r in asof_join(left, right, ["k"], "ts", ["v"]).collect()}
    assert got == {1: 7, 2: None, 3: None, 4: None}
    named = class_name_lookup(spark, spark.createDataFrame([(0,), (9,), (None,)], "class_id int"))
    assert {(r.class_id, r.class_name) for r in named.collect()} == {(0, "person"), (9, "class_9"), (None, None)}
