"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first d turns. It is named by its smallest
member and its depth, which no other node has, so the trie needs no ids of
its own; the path of a conversation is the list of the smallest members of
its prefixes, and the node of any ancestor is one equi-join away
(conversation, depth).

Texts are read once and become digests. Turns are numbered by a range
shuffle on (conversation, turn, digest), which splits a conversation of any
length over tasks; a prefix is identified by the running sums, modulo 2^60,
of two 48-bit pieces of the digest of (place, turn), summed in pieces of
``_RUN`` turns whose totals are carried on. All other tables hold narrow rows.

Totals of subtrees come from the centroid decomposition of the forest of
parent edges. A component's centroid is its deepest node that holds at least
half of it below and including itself. Its part of the component is added up
once and put on the centroid and on every node from there to the component's
top; the centroid is taken out, every child's subtree and the rest above
become components of their own, and so on: every node and each of its
descendants are parted at exactly one centroid between them, so each counts
once, and a chain of n nodes takes log n rounds. Components of more than
``bound`` nodes are split by rounds of joins over the whole forest at once;
the others are dealt over tasks and finished there, many at a time.

Defined cases: rows without a conversation id take no part; a null role or
text is empty; null turns come first, and turns of one number are ordered by
the SHA-256 of their role and text, so equal rows are interchangeable; rows
that repeat are turns of their own; extra columns are ignored whatever their
names; very long conversations and texts as above; an empty table has no
members, hence no nodes, and gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.common import small_batches
from sightline.session import materialize

#: Turns of a conversation that are summed in one run. 2^12 pieces of 48 bits
#: stay below 2^60.
_RUN = 1 << 12
_MODULUS = 1 << 60


# turns -------------------------------------------------------------------

def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv, pos from 0, x, points): each conversation's turns in order, as
    digests of role and text, with the code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = (turns.where(F.col(conv_col).isNotNull())
            .select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                    F.substring(whole, 1, 32).alias("x"), F.char_length(text).cast("long").alias("points"))
            .repartitionByRange("conv", "turn", "x").withColumn("part", F.spark_partition_id())
            .transform(lambda df: materialize(df, "turns")))
    # only conversations that lie over several parts need an offset
    sizes = rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = sizes.withColumn("skip", F.sum("n").over(before)).where("skip > 0").select("conv", "part", "skip")
    own = F.row_number().over(Window.partitionBy("conv", "part").orderBy(F.col("turn").asc_nulls_first(), "x"))
    return (rows.withColumn("own", own.cast("long")).join(carry, ["conv", "part"], "left")
            .select("conv", (F.col("own") - 1 + F.coalesce("skip", F.lit(0))).alias("pos"), "x", "points"))


def conversations(numbered: DataFrame) -> DataFrame:
    """(conv, n): one row for each conversation with its number of turns."""
    return numbered.groupBy("conv").agg((F.max("pos") + 1).alias("n"))


def shared_openings(numbered: DataFrame, convs: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """The turns of rebuilt conversations: conversation c starts with the
    first h = crc32(c) % ``heads`` turns of conversation c - c % ``every``,
    followed by its own turns after its first h."""
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(heads))
    plan = convs.select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    base_n = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = plan.join(base_n, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    own = (numbered.join(plan.select("conv", "h", "taken"), "conv").where("pos >= h")
           .select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "x", "points"))
    # at most heads - 1 turns of a base, each for fewer than 2 x every conversations
    head = numbered.where((F.col("conv") % every == 0) & (F.col("pos") < heads - 1)).withColumnRenamed("conv", "base")
    opened = head.join(plan.select("conv", "base", "h"), "base").where("pos < h").select("conv", "pos", "x", "points")
    return own.unionByName(opened)


# nodes -------------------------------------------------------------------

def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, points) of written turns: equal (depth, k1, k2)
    are equal sequences of first turns."""
    digest = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("x")), 256)

    def piece(at: int) -> Column:
        return F.conv(F.substring("digest", at, 12), 16, 10).cast("long")
    rows = (turns.withColumn("digest", digest)
            .select("conv", (F.col("pos") + 1).alias("depth"), F.floor(F.col("pos") / _RUN).alias("run"), "points",
                    piece(1).alias("f1"), piece(13).alias("f2")))
    within = Window.partitionBy("conv", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("conv", "depth", "run", "points", F.sum("f1").over(within).alias("s1"),
                         F.sum("f2").over(within).alias("s2"))
    before = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv", "run").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("f1", "f2")])
    carry = totals.select("conv", "run", *[F.sum(c).over(before).alias(c) for c in ("f1", "f2")]).where("run > 0")

    def carried(own: str, so_far: str) -> Column:
        c = F.coalesce((F.col(so_far) % F.lit(_MODULUS)).cast("long"), F.lit(0))
        return F.pmod(F.col(own) + c, F.lit(_MODULUS))
    return summed.join(carry, ["conv", "run"], "left").select(
        "conv", "depth", carried("s1", "f1").alias("k1"), carried("s2", "f2").alias("k2"), "points")


def trie_paths(turns: DataFrame, hot_share: int = 10_000) -> DataFrame:
    """(conv, depth, owner, n_convs, points): for each prefix of each
    conversation the smallest member of its node, and their number.

    Nodes that hold one in ``hot_share`` of all prefixes, at most that many,
    are broadcast, so their members stay where they are."""
    rows = materialize(prefixes(turns), "trie-prefixes")
    key = ["depth", "k1", "k2"]
    nodes = materialize(rows.groupBy(*key).agg(F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs")), "trie-owners")
    is_hot = F.col("n_convs") >= max(256, -(-rows.count() // hot_share))
    hot = F.broadcast(nodes.where(is_hot))
    met = rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(nodes.where(~is_hot), key))
    return met.select("conv", "depth", "owner", "n_convs", "points")


def ends_digests(ends: DataFrame, together: int = 4096) -> DataFrame:
    """(owner, depth, ends_sha256) from (owner, depth, conv): SHA-256 of the
    comma-joined ids, ascending. Ranges of ids are joined where the range
    shuffle has put them, so a node with any number of ends is spread; one
    task then streams its few long strings, in order, through the hash."""
    small_batches(ends.sparkSession)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids = None, None, []

        def row():
            return pa.RecordBatch.from_pylist([{"owner": node[0], "depth": node[1], "first": first, "ids": ",".join(ids)}],
                                              schema=schema)
        schema = pa.schema([("owner", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
        for b in batches:
            done = []
            for o, d, c in zip(*(b.column(x).to_pylist() for x in ("owner", "depth", "conv"))):
                if node != (o, d) or len(ids) >= together:
                    if ids:
                        done.append((*node, first, ",".join(ids)))
                    node, first, ids = (o, d), c, []
                ids.append(str(c))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*done), schema)], schema=schema)
        if ids:
            yield row()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("owner", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
        node, sha = None, None
        for b in batches:
            done = []
            for o, d, ids in zip(*(b.column(x).to_pylist() for x in ("owner", "depth", "ids"))):
                if node == (o, d):
                    sha.update(b"," + ids.encode())
                else:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (o, d), hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*done), schema)], schema=schema)
        if node:
            yield pa.RecordBatch.from_pylist([{"owner": node[0], "depth": node[1], "ends_sha256": sha.hexdigest()}],
                                             schema=schema)
    joined = (ends.repartitionByRange("owner", "depth", "conv").sortWithinPartitions("owner", "depth", "conv")
              .mapInArrow(join, "owner long, depth long, first long, ids string"))
    return (joined.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first")
            .mapInArrow(digest, "owner long, depth long, ends_sha256 string"))


# rollup ------------------------------------------------------------------

def centroid_sums(parent: np.ndarray, layer: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums over subtrees of a forest: ``parent`` (-1: a top) and ``layer``
    (grows by one from parent to child) of every node, ``values`` by column.
    All components are split at their centroids at once."""
    n, total = len(parent), np.zeros_like(values)
    order = np.argsort(layer, kind="stable")
    layers = np.split(order, np.flatnonzero(np.diff(layer[order])) + 1) if n else []
    up = parent.copy()                                   # edges inside components
    live = np.ones(n, dtype=bool)
    while live.any():
        layers = [x for x in (x[live[x]] for x in layers) if len(x)]
        size, top = np.ones(n, dtype=np.int64), np.arange(n)
        for x in reversed(layers):
            x = x[up[x] >= 0]
            np.add.at(size, up[x], size[x])
        for x in layers:
            x = x[up[x] >= 0]
            top[x] = top[up[x]]
        heavy = 2 * size >= size[top]
        centroid = np.full(n, -1)
        for x in layers:                                    # the deepest heavy node comes last
            x = x[heavy[x]]
            centroid[top[x]] = x
        c = centroid[np.flatnonzero(live & (up < 0))]
        mine = np.full(n, -1)                             # the centroid above or at a node
        mine[c] = np.arange(len(c))
        for x in layers:
            x = x[(mine[x] < 0) & (up[x] >= 0)]
            mine[x] = mine[up[x]]
        below = np.flatnonzero(live & (mine >= 0))
        part = np.zeros((len(c), values.shape[1]), dtype=values.dtype)
        np.add.at(part, mine[below], values[below])
        at, of = c, np.arange(len(c))
        while len(at):                                      # from the centroids to their tops
            total[at] += part[of]
            go = up[at] >= 0
            at, of = up[at[go]], of[go]
        live[c] = False
        cut = np.isin(up, c)
        up[cut] = -1
        up[c] = -1
    return total


def _finish(values: list[str]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        comp = pd.MultiIndex.from_frame(rows[["comp", "comp_depth"]]).factorize()[0]
        own = pd.MultiIndex.from_arrays([comp, rows["owner"], rows["depth"]])
        parent = own.get_indexer(pd.MultiIndex.from_arrays([comp, rows["parent"], rows["depth"] - 1]))
        sums = centroid_sums(parent, rows["depth"].to_numpy(), rows[values].to_numpy())
        for i, v in enumerate(values):
            rows["sum_" + v] += sums[:, i]
        return rows.drop(columns=["comp", "comp_depth"])
    return run


def _split_large(live: DataFrame, paths: DataFrame, counts: DataFrame, values: list[str], columns: list[str]) -> DataFrame:
    """One round over all large components: the rows of ``live`` with their
    sums, sizes and components after their centroid is taken out; it keeps
    a null component."""
    comp = ["comp", "comp_depth"]
    heavy = live.join(counts, comp).where(F.col("size") * 2 >= F.col("n"))
    centroid = heavy.groupBy(*comp).agg(F.max_by(F.struct("owner", "depth", "size"), "depth").alias("c"))
    rows = live.join(centroid, comp)
    deep = F.col("depth") >= F.col("c.depth")
    rows = rows.withColumn("at_conv", F.when(deep, F.col("owner")).otherwise(F.col("c.owner"))) \
               .withColumn("at_depth", F.least("depth", "c.depth"))
    at = paths.select(F.col("conv").alias("at_conv"), F.col("depth").alias("at_depth"), F.col("owner").alias("met"), "next")
    rows = rows.join(at, ["at_conv", "at_depth"])
    below = (F.col("depth") >= F.col("c.depth")) & (F.col("met") == F.col("c.owner"))
    above = (F.col("depth") < F.col("c.depth")) & (F.col("met") == F.col("owner"))
    rows = materialize(rows.select(*columns, "c", "next", below.alias("below"), above.alias("above")), "trie-round")
    part = rows.where("below").groupBy(*comp).agg(*[F.sum(v).alias("part_" + v) for v in values])
    rows = rows.join(part, comp)
    is_c = F.col("below") & (F.col("depth") == F.col("c.depth"))
    new = {"sum_" + v: F.col("sum_" + v) + F.when(is_c | F.col("above"), F.col("part_" + v)).otherwise(0) for v in values}
    new["size"] = F.col("size") - F.when(F.col("above"), F.col("c.size")).otherwise(0)
    new["comp"] = F.when(is_c, F.lit(None)).when(F.col("below"), F.col("next")).otherwise(F.col("comp"))
    new["comp_depth"] = F.when(F.col("below"), F.col("c.depth") + 1).otherwise(F.col("comp_depth"))
    return rows.select(*[new[c].cast("long").alias(c) if c in new else F.col(c) for c in columns])


def subtree_sums(nodes: DataFrame, paths: DataFrame, root: int, values: list[str], bound: int = 4096) -> DataFrame:
    """``nodes`` (owner, depth, parent, and longs ``values``; written; any
    parent for the root) with ``sum_`` of each value over the subtree. ``paths`` (conv, depth, owner)
    gives every conversation's nodes from depth 1 on."""
    keep = nodes.columns + ["sum_" + v for v in values]
    live = nodes.select("*", *[F.lit(0).cast("long").alias("sum_" + v) for v in values],
                        F.lit(root).cast("long").alias("comp"), F.lit(0).cast("long").alias("comp_depth"))
    total = nodes.count()
    done: list[DataFrame] = []
    if total > bound:
        # nodes below a node: what each conversation owns of its path is the end of it
        owned = nodes.groupBy("owner").agg(F.min("depth").alias("since"), F.max("depth").alias("until"))
        own_paths = paths.select("conv", "depth", "owner").join(owned.withColumnRenamed("owner", "conv"), "conv")
        size = (own_paths.groupBy("owner", "depth")
                .agg(F.sum(F.col("until") - F.greatest("depth", "since") + 1).alias("size")))
        live = live.join(size, ["owner", "depth"], "left").withColumn("size", F.coalesce("size", F.lit(total)))
        tops = own_paths.select("conv").distinct().select("conv", F.lit(0).cast("long").alias("depth"),
                                                          F.lit(root).cast("long").alias("owner"))
        steps = own_paths.select("conv", "depth", "owner").unionByName(tops)
        after = steps.select("conv", (F.col("depth") - 1).alias("depth"), F.col("owner").alias("next"))
        steps = materialize(steps.join(after, ["conv", "depth"], "left"), "trie-steps")
        columns = live.columns
        live = materialize(live.select(*columns), "trie-live")
        comp = ["comp", "comp_depth"]
        while True:
            counts = live.groupBy(*comp).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound)
            counts = materialize(counts, "trie-large")
            if counts.isEmpty():
                break
            done.append(live.join(counts, comp, "left_anti").drop("size"))
            after = materialize(_split_large(live.join(counts, comp, "left_semi"), steps, counts, values, columns), "trie-live")
            done.append(after.where("comp IS NULL").drop("size"))
            live = after.where("comp IS NOT NULL")
        live = live.drop("size")
    schema = live.drop("comp", "comp_depth").schema
    for d in done:
        live = live.unionByName(d)
    finished = live.where("comp IS NULL").select(*keep)
    rest = live.where("comp IS NOT NULL")
    tasks = max(1, -(-total // bound))
    dealt = rest.withColumn("task", F.pmod(F.xxhash64("comp", "comp_depth"), F.lit(tasks)))
    fin = _finish(values)
    out = dealt.groupBy("task").applyInPandas(lambda rows: fin(rows.drop(columns="task"))[schema.names], schema)
    return out.select(*keep).unionByName(finished)


# the whole ---------------------------------------------------------------

def prefix_trie(turns: DataFrame, convs: DataFrame, bound: int = 4096) -> DataFrame:
    """One row for each node of the trie of ``turns`` (conv, pos, x, points),
    whose members are the conversations of ``convs`` (conv): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    Both are read several times, so pass written tables."""
    spark = convs.sparkSession
    root, members = convs.agg(F.min("conv"), F.count(F.lit(1))).first()
    paths = materialize(trie_paths(turns), "trie-paths")
    top = spark.range(1 if members else 0).select(
        F.lit(root).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("parent"),
        F.lit(members).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("points"))
    above = paths.select("conv", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    nodes = (paths.where("conv = owner").join(above, ["conv", "depth"], "left")
             .select("owner", "depth", F.when(F.col("depth") == 1, F.lit(root)).otherwise(F.col("parent")).cast("long").alias("parent"),
                     "n_convs", "points").unionByName(top))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["owner", "depth"], "left").select(
        "owner", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("points")).alias("saved"))
    nodes = materialize(nodes, "trie-nodes")
    last = paths.groupBy("conv").agg(F.max(F.struct("depth", "owner")).alias("end"))
    ends = convs.select("conv").join(last, "conv", "left").select(
        F.coalesce("end.owner", F.lit(root)).alias("owner"), F.coalesce("end.depth", F.lit(0)).cast("long").alias("depth"), "conv")
    digests = ends_digests(materialize(ends, "trie-ends"))
    summed = subtree_sums(nodes, paths, root, ["leaves", "saved"], bound)
    return summed.join(digests, ["owner", "depth"], "left").select(
        F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), "n_convs", "n_children",
        F.col("sum_leaves").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, every: int = 100, heads: int = 6, bound: int = 4096,
                      **columns: str) -> DataFrame:
    """The trie of the conversations rebuilt by ``shared_openings``."""
    numbered = materialize(numbered_turns(turns, **columns), "numbered")
    convs = materialize(conversations(numbered), "convs")
    return prefix_trie(materialize(shared_openings(numbered, convs, every, heads), "rebuilt"), convs, bound)
