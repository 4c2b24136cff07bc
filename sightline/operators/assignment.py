"""One-to-one matching and what is measured on it.

``greedy_matching`` takes pairs best first, each if both its ends are still
free: the result of going through the sorted pairs one by one. It is built
from locally best pairs: a pair that comes first among all pairs of either
end is taken in any order of work, so all such pairs are taken at once,
pairs that share an end with them go, and the rest is looked at again.
Groups (frames) of at most ``local`` pairs are dealt over tasks and finished
there; a group with more is solved by rounds of two aggregations and joins
on the remaining pairs, spread by their ends.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import materialize


def best_first(a: np.ndarray, b: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Mask of the pairs that greedy matching takes; ``rank`` is distinct,
    the least comes first; equal ends are equal numbers from 0 on."""
    taken = np.zeros(len(a), dtype=bool)
    left = np.arange(len(a))
    none = np.iinfo(np.int64).max
    while len(left):
        x, y, r = a[left], b[left], rank[left]
        best_a, best_b = np.full(a.max() + 1, none), np.full(b.max() + 1, none)
        np.minimum.at(best_a, x, r)
        np.minimum.at(best_b, y, r)
        first = (best_a[x] == r) & (best_b[y] == r)
        taken[left[first]] = True
        used_a, used_b = np.zeros(len(best_a), dtype=bool), np.zeros(len(best_b), dtype=bool)
        used_a[x[first]], used_b[y[first]] = True, True
        left = left[~(used_a[x] | used_b[y])]
    return taken


def greedy_matching(pairs: DataFrame, group: Sequence[str], a_id: Sequence[str], b_id: Sequence[str],
                    order: Sequence[tuple[str, bool]], local: int = 4096) -> DataFrame:
    """The rows of ``pairs`` that greedy matching takes. Ends are ``group`` +
    ``a_id`` and ``group`` + ``b_id``; a pair of ends occurs once. ``order``:
    columns and whether they ascend; the ids break ties, so it is total.
    Pairs with a null end or a null in the order are never taken."""
    group, a_id, b_id = list(group), list(a_id), list(b_id)
    whole = [*group, *a_id, *b_id, *[c for c, _ in order]]
    columns = pairs.columns
    known = F.lit(True)
    for c in whole:
        known = known & F.col(c).isNotNull()
    pairs = materialize(pairs.where(known), "match-pairs")
    ties = [c for c in [*a_id, *b_id] if c not in [c for c, _ in order]]
    by = [*order, *[(c, True) for c in ties]]

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([c for c, _ in by], ascending=[up for _, up in by], kind="stable")
        ends = [pd.MultiIndex.from_frame(rows[[*group, *ids]]).factorize()[0] for ids in (a_id, b_id)]
        return rows[best_first(*ends, np.arange(len(rows)))][columns]
    sizes = pairs.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    large = materialize(sizes.where(F.col("_n") > local).select(*group), "match-large")
    if large.isEmpty():
        small, left = pairs, None
    else:
        small = pairs.join(large, group, "left_anti")
        left = materialize(pairs.join(large, group, "left_semi"), "match-left")
    tasks = max(1, -(-pairs.count() // local))
    out = (small.withColumn("_task", F.pmod(F.xxhash64(*group), F.lit(tasks))).groupBy("_task")
           .applyInPandas(lambda rows: solve(rows.drop(columns="_task")), pairs.schema))

    def place(c: str, up: bool) -> Column:
        return F.col(c) if up else -F.col(c)
    rank = F.struct(*[place(c, up).alias(f"o{i}") for i, (c, up) in enumerate(by)], *[F.col(c) for c in [*a_id, *b_id]])
    while left is not None and not left.isEmpty():
        ranked = left.withColumn("_rank", rank)
        best = [ranked.groupBy(*group, *ids).agg(F.min("_rank").alias("_rank")) for ids in (a_id, b_id)]
        key = [*group, *a_id, *b_id]
        pick = [b.select(*[F.col(c) if c in b.columns else F.col("_rank")[c].alias(c) for c in key]) for b in best]
        first = materialize(pick[0].join(pick[1], key), "match-first")
        out = out.unionByName(left.join(first, key, "left_semi"))
        left = materialize(left.join(first.select(*group, *a_id), [*group, *a_id], "left_anti")
                           .join(first.select(*group, *b_id), [*group, *b_id], "left_anti"), "match-left")
    return out


def precision_recall_curve(preds: DataFrame, truths: DataFrame, hits: DataFrame, key: str, score: str,
                           digits: int = 3) -> DataFrame:
    """(key, threshold, n_pred, tp, n_truth, precision, recall): what counts
    if only predictions of at least ``threshold`` do, for every score that
    occurs, rounded down to ``digits``. ``hits`` are the matched predictions
    with their score. A key without truths has null recall; one without
    predictions has no row. Rows per key are bounded by the digits."""
    step = 10 ** digits

    def at(df: DataFrame, name: str) -> DataFrame:
        return (df.where(F.col(score).isNotNull() & ~F.isnan(score))
                .groupBy(key, F.floor(F.col(score) * step + 1e-9).cast("long").alias("_t"))
                .agg(F.count(F.lit(1)).alias(name)))
    n = truths.groupBy(key).agg(F.count(F.lit(1)).alias("n_truth"))
    above = Window.partitionBy(key).orderBy(F.col("_t").desc()).rowsBetween(Window.unboundedPreceding, 0)
    c = at(preds, "_p").join(at(hits, "_h"), [key, "_t"], "left").join(n, key, "left")
    c = c.select(key, "_t", (F.col("_t") / step).alias("threshold"), F.sum("_p").over(above).alias("n_pred"),
                 F.sum(F.coalesce("_h", F.lit(0))).over(above).alias("tp"), F.coalesce("n_truth", F.lit(0)).alias("n_truth"))
    return c.select(key, "threshold", "n_pred", "tp", "n_truth", (F.col("tp") / F.col("n_pred")).alias("precision"),
                    F.try_divide("tp", "n_truth").alias("recall"))


def average_precision(curve: DataFrame, key: str) -> DataFrame:
    """(key, ap): the area under the curve of precision over recall, where a
    recall counts with the best precision at it or beyond."""
    by = Window.partitionBy(key).orderBy(F.col("threshold").desc())
    best = F.max("precision").over(Window.partitionBy(key).orderBy("threshold")
                                   .rowsBetween(Window.unboundedPreceding, 0))
    step = F.col("recall") - F.coalesce(F.lag("recall").over(by), F.lit(0.0))
    return (curve.withColumn("_best", best).withColumn("_step", step)
            .groupBy(key).agg(F.sum(F.col("_step") * F.col("_best")).alias("ap")))
