"""Connected components over an edge DataFrame (V4, V7).

Randomised contraction: in every round each vertex is renamed by a
one-to-one hash of its id that differs from round to round, takes the
smallest name among itself and its neighbours as its representative, and
every edge is rewritten to the representatives of its two ends. Loops and
duplicates go. A random order makes a constant share of the vertices
disappear in every round, also on chains in the worst order, so the edge
table shrinks geometrically, the rounds are logarithmic in the largest
component, and no round limit is needed. The renamings are then composed
from the last round back to the first, with one join each over tables that
grow geometrically, and every component takes the name of its least member.

The tables of a round are written under ``spark.checkpoint.dir``
(``session.materialize``: computed once, unlike ``Dataset.checkpoint``,
which computes twice), so the plan does not grow and a lost executor
only replays one round. No link, component or label reaches the driver;
it only learns from each round's Parquet footers whether edges are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import checkpoint_dir, materialize


def component_labels(edges: DataFrame, src: str = "src", dst: str = "dst",
                     rounds: list[int] | None = None) -> DataFrame:
    """(``v``, ``component``) of every vertex that has an edge to another
    vertex; ``component`` is the least member id.

    Ids may be any orderable type. Null ends, loops and repeated edges are
    ignored. ``rounds``, if given, receives the vertex count of each round
    (one extra action a round; for tests).
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    id_type = edges.schema[src].dataType

    def name(c, r):  # one-to-one on longs; other types are hashed to a long once
        return F.xxhash64(F.lit(r), c)

    e0 = (edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
          .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))))
    members = None
    if id_type.typeName() != "long":
        # ids that are not longs get one: their rank is not needed, only identity
        both = e0.select(F.col("a").alias("id")).union(e0.select(F.col("b").alias("id"))).distinct()
        members = both.select("id", F.xxhash64("id").alias("v")).transform(materialize)
        e0 = e0.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    e = (e0.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
         .transform(materialize))
    maps: list[DataFrame] = []
    while not e.isEmpty():
        r = len(maps) + 1
        ends = (e.select("a", name(F.col("b"), r).alias("h"))
                .unionAll(e.select(F.col("b").alias("a"), name(F.col("a"), r).alias("h"))))
        m = (ends.groupBy("a").agg(F.min("h").alias("h"))
             .select(F.col("a").alias("v"), F.least(name(F.col("a"), r), "h").alias("rep"))
             .transform(materialize))
        maps.append(m)
        if rounds is not None:
            rounds.append(m.count())
        ra = e.join(m.select(F.col("v").alias("a"), F.col("rep").alias("ra")), "a")
        rb = ra.join(m.select(F.col("v").alias("b"), F.col("rep").alias("rb")), "b").where("ra <> rb")
        e = (rb.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
             .transform(materialize))
    if not maps:
        empty = e0.limit(0).select(F.col("a").alias("v"), F.col("a").alias("component"))
        return empty if members is None else members.limit(0).select(
            F.col("id").alias("v"), F.col("id").alias("component"))
    # (round, name) identifies a component: names of different rounds never meet
    lab = maps[-1].select("v", F.lit(len(maps)).alias("at"), F.col("rep").alias("label"))
    for r in range(len(maps) - 1, 0, -1):
        later = lab.select(F.col("v").alias("rep"), F.col("at").alias("at2"), F.col("label").alias("label2"))
        lab = (maps[r - 1].join(later, "rep", "left")
               .select("v", F.coalesce("at2", F.lit(r)).alias("at"), F.coalesce("label2", "rep").alias("label")))
        if r % 4 == 1:
            lab = lab.transform(materialize)
    if members is not None:
        lab = members.join(lab, "v").select(F.col("id").alias("v"), "at", "label")
    lab = lab.transform(materialize)
    least = lab.groupBy("at", "label").agg(F.min("v").alias("component"))
    return lab.join(least, ["at", "label"]).select("v", "component")


def connected_components(vertices: DataFrame, edges: DataFrame, vid: str = "id",
                         src: str = "src", dst: str = "dst", out: str = "component") -> DataFrame:
    """Label every vertex with the least vertex id of its component.

    ``vertices`` has column ``vid``; ``edges`` has ``src``/``dst`` of the
    same type (undirected). Vertices without an edge are their own
    component.
    """
    lab = component_labels(edges, src, dst).select(F.col("v").alias(vid), F.col("component").alias(out))
    return (vertices.select(vid).distinct().join(lab, vid, "left")
            .withColumn(out, F.coalesce(F.col(out), F.col(vid))))


def chain_heads(links: DataFrame, src: str = "src", dst: str = "dst", out: str = "head") -> DataFrame:
    """Head of every chain for links where each vertex has at most one
    predecessor (tracks built from mutual-best frame-to-frame links).

    Pointer jumping on the predecessor: ``p(v) <- p(p(v))`` until no
    pointer moves, so a chain of length L needs about log2(L) rounds of one
    join each. Vertices whose pointer has reached a head leave the loop, so
    the tables shrink. Returns (``dst``-side vertex, head) for every linked
    vertex; vertices that are never a ``dst`` are their own head. The links
    must not form a cycle (a frame-ordered link never does).
    """
    checkpoint_dir(links.sparkSession)
    done: DataFrame | None = None
    ptr = links.select(F.col(dst).alias("v"), F.col(src).alias("p")).transform(materialize)
    moving = ptr
    while not moving.isEmpty():
        # every pointer so far: those at a head and those still moving
        known = moving if done is None else moving.unionByName(done)
        nxt = known.select(F.col("v").alias("pv"), F.col("p").alias("pp"))
        jumped = (moving.join(nxt, moving["p"] == nxt["pv"], "left")
                  .select("v", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved"))
                  .transform(materialize))
        at_head = jumped.where("not moved").select("v", "p")
        done = at_head if done is None else done.unionByName(at_head)
        moving = jumped.where("moved").select("v", "p")
    out_df = ptr.limit(0) if done is None else done
    return out_df.select(F.col("v").alias(dst), F.col("p").alias(out))
