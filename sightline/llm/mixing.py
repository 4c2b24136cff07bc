"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies, target
over size of the source. Its whole part is certain; the fractional parts
are rounded together: two documents with probabilities strictly between 0
and 1 meet, and mass moves from one to the other, in a random direction
with the odds that keep both expectations, until one of them is 0 or 1. The
mass is counted in words, so the words of the source stay where they are.

The pairing runs as a reduction tree. The documents of a source are dealt
by hash over blocks of about ``block`` documents; each block is reduced in
one task and leaves at most one undecided document. These residuals meet in
blocks of the next level, until a source has one left, which a last draw
decides. So a source's words miss its target by less than one document, a
source that holds most of the corpus is spread over many tasks, and only
residuals move after the first level. All draws are seeded by what the block
is, and documents meet in the order of their hash, so reruns agree.

Defined cases: a null text is empty and has size 0 and no copies beyond the
certain ones; a null source is a source of its own, ordered last; rows that
repeat id and text are decided together and get equal copies; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.common import WORD_CLASS
from sightline.session import materialize


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_CLASS)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, sid, docs, source_size, target) from (source, docs, source_size).

    The total is shared by the weights, which repeat over the sources in code
    point order (null last); no target is above ``most`` times its source,
    and what that frees is shared again. In the order of size over weight the
    stopped sources come first, so running sums over the table of sources
    (one row each) give the fixed point at once, in whole numbers."""
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), F.pmod(F.col("sid"), F.lit(len(weights))).cast("int") + 1)
    s = sizes.withColumn("sid", (F.row_number().over(
        Window.orderBy(F.col("source").isNull(), "source")) - 1).cast("long")).withColumn("w", w.cast("long"))
    by = Window.orderBy(F.col("source_size") / F.col("w"), "sid")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = (s.withColumn("total", F.sum("source_size").over(everything))
         .withColumn("total_w", F.sum("w").over(everything))
         .withColumn("gone", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
         .withColumn("left_w", F.col("total_w") - F.coalesce(F.sum("w").over(before), F.lit(0)))
         .withColumn("free", (F.col("total") - F.col("gone")).cast("decimal(38,0)")))
    s = s.withColumn("stopped", F.col("free") * F.col("w") >= F.col("source_size").cast("decimal(20,0)")
                     * F.lit(most) * F.col("left_w"))
    # the first source that is not stopped says what a unit of weight gets
    first = F.min(F.when(~F.col("stopped"), F.struct(F.col("source_size") / F.col("w"), "sid", "free", "left_w"))).over(everything)
    s = s.withColumn("first", first)
    target = F.when(F.col("stopped"), (F.col("source_size") * most).cast("double")).otherwise(
        (F.col("first.free") * F.col("w")).cast("double") / F.col("first.left_w"))
    return s.select("source", "sid", "docs", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _pivot(p: np.ndarray, w: np.ndarray, rng: np.random.Generator) -> int:
    """Rounds ``p`` in place, mass counted by ``w``; index of the one that
    stays undecided, or -1."""
    draws = rng.random(len(p))
    open_at = -1
    pl, wl = p.tolist(), w.tolist()
    for i in range(len(pl)):
        if not 0.0 < pl[i] < 1.0:
            continue
        if open_at < 0:
            open_at = i
            continue
        a, b = open_at, i
        up = min(wl[a] * (1 - pl[a]), wl[b] * pl[b])        # a gains, b loses
        down = min(wl[a] * pl[a], wl[b] * (1 - pl[b]))      # a loses, b gains
        move = up if draws[i] * (up + down) < down else -down
        pl[a] += move / wl[a]
        pl[b] -= move / wl[b]
        for j in (a, b):
            if pl[j] < 1e-12:
                pl[j] = 0.0
            elif pl[j] > 1 - 1e-12:
                pl[j] = 1.0
        open_at = a if 0.0 < pl[a] < 1.0 else b if 0.0 < pl[b] < 1.0 else -1
    p[:] = pl
    return open_at


def _reduce(level: int, seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["k", "uid"], kind="stable", na_position="last").reset_index(drop=True)
        p = rows["p"].to_numpy(dtype=float).copy()
        rng = np.random.default_rng([seed, level, int(rows["sid"].iloc[0]), int(rows["block"].iloc[0])])
        _pivot(p, rows["weight"].to_numpy(dtype=float), rng)
        rows["p"] = p
        return rows
    return run


def mix_to_targets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   weights: tuple[int, ...] = (1, 2, 3), most: int = 3, block: int = 4096, fan_in: int = 256,
                   seed: int = 7) -> DataFrame:
    """One row per document: id, k (hash of id, text and source), size, source_size,
    target (its source's) and ``copies``, the times the mix takes it."""
    spark = docs.sparkSession
    t = F.coalesce(F.col(text_col), F.lit(""))
    units = (docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                         F.xxhash64(F.col(id_col), t, F.col(source_col)).alias("k"), n_words(F.col(text_col)).alias("size"))
             .groupBy("id", "source", "k", "size").agg(F.count(F.lit(1)).alias("rows"))
             .transform(lambda d: materialize(d, "mix-units")))
    sizes = units.groupBy("source").agg(F.count(F.lit(1)).alias("docs"),
                                        F.coalesce(F.sum(F.col("size") * F.col("rows")), F.lit(0)).alias("source_size"))
    targets = source_targets(sizes, weights, most).transform(lambda d: materialize(d, "mix-targets"))
    u = units.join(targets, units["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sure = F.floor(rate + 1e-12)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("docs") / block))
    u = u.select("id", "k", "size", "rows", "sid", "source_size", "target", sure.alias("sure"),
                 F.when(F.col("size") > 0, F.greatest(rate - sure, F.lit(0.0))).otherwise(F.lit(0.0)).alias("p"),
                 (F.col("size") * F.col("rows")).alias("weight"),
                 F.pmod(F.xxhash64("k"), blocks).alias("block"), F.col("id").cast("string").alias("uid"))
    most_blocks = targets.agg(F.max(F.ceil(F.col("docs") / block))).first()[0] or 1
    shape = u.schema
    open_ = (F.col("p") > 0) & (F.col("p") < 1)
    step = u.groupBy("sid", "block").applyInPandas(_reduce(0, seed), shape).transform(
        lambda d: materialize(d, "mix-0"))
    done = [step.where(~open_)]
    level = 0
    while most_blocks > 1:
        level += 1
        most_blocks = -(-most_blocks // fan_in)
        step = (step.where(open_).withColumn("block", F.expr(f"block div {fan_in}"))
                .groupBy("sid", "block").applyInPandas(_reduce(level, seed), shape)
                .transform(lambda d, n=level: materialize(d, f"mix-{n}")))
        done.append(step.where(~open_))
    # one document a source may be left: a draw of its own decides it
    draw = (F.pmod(F.xxhash64(F.lit(seed), "sid", "k"), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    last = step.where(open_).withColumn("p", F.when(draw < F.col("p"), F.lit(1.0)).otherwise(F.lit(0.0)))
    out = last
    for d in done:
        out = out.unionByName(d)
    return (out.select(F.col("id").alias(id_col), "k", "size", "source_size", "target",
                       (F.col("sure") + F.col("p")).cast("long").alias("copies"),
                       F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("row")).drop("row"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **options) -> DataFrame:
    """The input rows, each as often as the mix takes it (all columns). The
    rows meet their copies by a sort-merge join at every size, so what a run
    moves grows with its input, and Spark splits it where a key is hot."""
    from sightline.llm.common import fresh
    k, n = fresh("mix_k", docs.columns), fresh("mix_copies", docs.columns)
    m = (mix_to_targets(docs, id_col, text_col, source_col, **options)
         .select(F.col("k").alias(k), F.col("copies").alias(n)).where(F.col(n) > 0).distinct())
    key = F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")), F.col(source_col))
    j = docs.withColumn(k, key).join(m.hint("merge"), k)
    one = fresh("mix_one", j.columns)
    return j.withColumn(one, F.explode(F.array_repeat(F.lit(0), F.col(n).cast("int")))).select(*docs.columns)
