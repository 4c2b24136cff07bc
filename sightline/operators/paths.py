"""Reachability and shortest paths over a directed graph.

``least_costs`` finds, for every pair of nodes that a path joins, the least
sum of edge costs along one. It works semi-naively: a round extends only the
pairs that the round before found or improved, by one edge, and keeps what
is better than what is known; it stops when nothing improves, however long
the paths are. A round is one equi-join on the node in the middle and one
aggregation; no path is kept, only the best cost of each pair. ``sources``
limits the work to paths from some nodes: all pairs of a graph are as many as
its reach, so a large graph should be asked from the nodes one needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.session import materialize


def least_costs(edges: DataFrame, src: str = "src", dst: str = "dst", cost: Column | None = None,
                sources: DataFrame | None = None, rounds: list[int] | None = None) -> DataFrame:
    """(src, dst, cost): the least cost of a path of at least one edge between
    different nodes; ``cost`` of an edge is 1 by default, so the result counts
    hops. Edges with a null end or cost, NaN or negative ones, and loops are
    left out; of parallel edges the cheapest counts. ``sources`` has the column
    ``src``. ``rounds`` receives the number of pairs that a round extends."""
    c = F.lit(1).cast("long") if cost is None else cost.cast("double")
    e = (edges.select(F.col(src).alias("m"), F.col(dst).alias("d"), c.alias("w"))
         .where(F.col("m").isNotNull() & F.col("d").isNotNull() & (F.col("m") != F.col("d")) & (F.col("w") >= 0))
         .where("w < double('infinity')").groupBy("m", "d").agg(F.min("w").alias("w")))
    e = materialize(e, "edges")
    front = e.select(F.col("m").alias("s"), F.col("d").alias("n"), F.col("w").alias("c"))
    if sources is not None:
        front = front.join(sources.select(F.col(src).alias("s")).distinct(), "s", "left_semi")
    front = materialize(front, "paths")
    known = front
    while not front.isEmpty():
        if rounds is not None:
            rounds.append(front.count())
        longer = (front.join(e, front["n"] == e["m"]).where(F.col("s") != F.col("d"))
                  .groupBy("s", F.col("d").alias("n")).agg(F.min(F.col("c") + F.col("w")).alias("c")))
        old = known.select("s", "n", F.col("c").alias("c0"))
        front = materialize(longer.join(old, ["s", "n"], "left").where("c0 IS NULL OR c < c0").select("s", "n", "c"), "paths")
        known = materialize(known.unionByName(front).groupBy("s", "n").agg(F.min("c").alias("c")), "known-paths")
    return known.select(F.col("s").alias(src), F.col("n").alias(dst), F.col("c").alias("cost"))


def reachability(edges: DataFrame, src: str = "src", dst: str = "dst", seconds: str = "seconds",
                 sources: DataFrame | None = None) -> DataFrame:
    """(src, dst, hops, seconds): fewest hops, and least travel time over any
    path, which may take more hops. Edges without a usable time count as hops
    only; a pair that only they join has null seconds."""
    hops = least_costs(edges, src, dst, None, sources).withColumnRenamed("cost", "hops")
    time = least_costs(edges, src, dst, F.col(seconds), sources).withColumnRenamed("cost", "seconds")
    return hops.join(time, [src, dst], "left")
