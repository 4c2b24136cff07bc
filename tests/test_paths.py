import random

import pytest
from pyspark.sql import functions as F

from sightline.operators import paths

NAN = float("nan")


def brute(edges, cost):
    best = {}
    for s, d, w in edges:
        if s is not None and d is not None and s != d and w is not None and w == w and 0 <= w < float("inf"):
            best[s, d] = min(best.get((s, d), float("inf")), 1 if cost == "hops" else w)
    nodes = {n for e in best for n in e}
    for m in nodes:
        for s in nodes:
            for d in nodes:
                if s != d and (s, m) in best and (m, d) in best:
                    best[s, d] = min(best.get((s, d), float("inf")), best[s, m] + best[m, d])
    return best


def test_random_graph_and_odd_edges(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(18), rnd.randrange(18), float(rnd.randrange(1, 30))) for _ in range(45)]
    edges += [(1, 1, 1.0), (None, 2, 1.0), (3, None, 1.0)] + edges[:4]
    df = spark.createDataFrame(edges, "src long, dst long, seconds double")
    got = {(r.src, r.dst): (r.hops, r.seconds) for r in paths.reachability(df).collect()}
    hops, time = brute(edges, "hops"), brute(edges, "seconds")
    assert got == {k: (hops[k], time[k]) for k in hops}
    some = spark.createDataFrame([(1,), (5,), (5,)], "src long")
    part = {(r.src, r.dst): r.hops for r in paths.reachability(df, sources=some).collect()}
    assert part == {k: v for k, v in hops.items() if k[0] in (1, 5)}


def test_long_chain_and_costs_that_are_none(spark):
    """No limit on hops; a slow edge is improved by a longer way; edges without a time count as hops."""
    chain = [(i, i + 1, 1.0) for i in range(12)] + [(0, 12, 100.0), (12, 13, None), (13, 14, -1.0), (14, 15, NAN)]
    df = spark.createDataFrame(chain, "src long, dst long, seconds double")
    rounds = []
    got = {(r.src, r.dst): r.cost for r in paths.least_costs(df, cost=F.col("seconds"), rounds=rounds).collect()}
    assert got[0, 12] == 12.0 and (12, 13) not in got and len(rounds) == 12
    hops = {(r.src, r.dst): (r.hops, r.seconds) for r in paths.reachability(df).collect()}
    assert hops[0, 12] == (1, 12.0) and hops[0, 15] == (4, None)


def test_empty(spark):
    assert paths.reachability(spark.createDataFrame([], "src string, dst string, seconds double")).count() == 0
