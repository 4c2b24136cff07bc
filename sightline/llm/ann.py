"""Approximate nearest neighbours by a hash-prefix forest.

Every tree gives each vector a long hash string: the signs of its products
with the directions of a random rotation. A tree is the sorted array of
these strings. A query descends each tree to its longest prefix match, by
binary search; then all trees ascend together, one character at a time, and
the rows under the query's prefix are added, until the trees hold the wanted
number of candidates. Their cosines are computed exactly, in double
precision, on the original vectors.

The rows are dealt by hash over blocks of about ``block`` rows, each with a
forest of its own, so a task holds one block and no vector, however often it
repeats, can fill more than its share. Queries are dealt over blocks of
``query_block`` and meet every row block; each meeting gives the best ``k``
of its rows, and a query's blocks are merged by a limited window. The wanted
number of candidates is a share of the block (``share``, counted over the
trees): vectors without structure, as random ones, have no prefixes that
tell near from far better than a constant factor, and recall of 0.9 at 5
needs about half of the rows there. With structure a smaller share does.

Defined cases: null, empty and zero vectors and those with null or
non-finite components take no part, as row or as query; rows meet only rows
of the same length; ties go to the smaller id; a repeated id is a candidate
as often as it occurs, but never for its own query, and asks once, with the
vector that sorts first; null ids take no part;
extra columns are ignored; fewer candidates than ``k`` give fewer rows; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not zero, every component there and finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def directions(dim: int, trees: int, depth: int, seed: int) -> np.ndarray:
    """(dim, trees x depth): for each tree orthonormal directions, repeated
    with new rotations if a string is longer than the vector."""
    rng = np.random.default_rng([seed, dim])
    out = []
    for _ in range(trees):
        cols = []
        while sum(c.shape[1] for c in cols) < depth:
            cols.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0])
        out.append(np.concatenate(cols, axis=1)[:, :depth])
    return np.concatenate(out, axis=1)


def hash_strings(x: np.ndarray, planes: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """(rows, trees) strings of ``depth`` bits as numbers, first bit highest."""
    bits = ((x @ planes) > 0).reshape(len(x), trees, depth)
    return bits @ (1 << np.arange(depth - 1, -1, -1, dtype=np.int64))


class Forest:
    """Sorted hash strings of one block."""

    def __init__(self, strings: np.ndarray, depth: int):
        self.depth, self.n = depth, len(strings)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)

    def candidates(self, queries: np.ndarray, wanted: int):
        """For each query the rows found by descending all trees and
        ascending them together until ``wanted`` are held (a row counts once
        for each tree)."""
        q, trees = queries.shape
        low = np.empty((self.depth + 1, trees, q), dtype=np.int64)
        high = np.empty_like(low)
        for t in range(trees):
            for x in range(self.depth + 1):
                p = queries[:, t] >> (self.depth - x)
                low[x, t] = np.searchsorted(self.sorted[:, t], p << (self.depth - x))
                high[x, t] = np.searchsorted(self.sorted[:, t], (p + 1) << (self.depth - x))
        held = (high - low).sum(axis=1)                    # prefix length x query
        stop = (held >= wanted).sum(axis=0) - 1             # longest prefix that holds enough
        stop = np.maximum(stop, 0)
        for j in range(q):
            x = stop[j]
            hit = np.zeros(self.n, dtype=bool)
            for t in range(trees):
                hit[self.order[low[x, t, j]:high[x, t, j], t]] = True
            yield j, np.flatnonzero(hit)


def _search(k: int, trees: int, depth: int, share: float, seed: int):
    def run(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(rows) and len(queries):
            rows, queries = rows.sort_values("id"), queries.sort_values("id")
            x, xi = np.stack(rows["vec"].to_numpy()).astype(np.float64), rows["id"].to_numpy()
            q, qi = np.stack(queries["vec"].to_numpy()).astype(np.float64), queries["id"].to_numpy()
            # scaled by powers of two, which is exact: squares neither overflow nor vanish
            x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
            q = np.ldexp(q, -np.frexp(np.abs(q).max(axis=1, keepdims=True))[1])
            norm, q_norm = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
            planes = directions(x.shape[1], trees, depth, seed)
            forest = Forest(hash_strings(x, planes, trees, depth), depth)
            wanted = int(min(np.ceil(share * len(x)) + k + 1, trees * len(x)))
            for j, at in forest.candidates(hash_strings(q, planes, trees, depth), wanted):
                at = at[xi[at] != qi[j]]
                # row by row in one order: equal vectors get equal scores
                s = (x[at] * q[j]).sum(axis=1) / (norm[at] * q_norm[j])
                if len(s) > k:
                    cut = np.partition(s, len(s) - k)[len(s) - k]
                    at, s = at[s >= cut], s[s >= cut]
                best = np.lexsort((xi[at], -s))[:k]
                out["query_id"] += [qi[j]] * len(best)
                out["vec_id"] += xi[at[best]].tolist()
                out["score"] += s[best].tolist()
        return pd.DataFrame({"query_id": np.array(out["query_id"], dtype=np.int64),
                             "vec_id": np.array(out["vec_id"], dtype=np.int64),
                             "score": np.array(out["score"], dtype=np.float64)})
    return run


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
            trees: int = 48, depth: int = 14, share: float = 0.65, block: int = 4096, query_block: int = 4096,
            seed: int = 11) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of the ``k`` nearest rows found
    for every row that ``is_query``; nearness is the cosine."""
    ok = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col)))
    base = ok.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                     F.size(vec_col).alias("dim"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    n, q = base.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    row_blocks, query_blocks = max(1, -(-n // block)), max(1, -(-q // query_block))

    def spread(df: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        return (df.withColumn(own, F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(own_n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))))
    rows = spread(base, "rb", row_blocks, "qb", query_blocks).select("dim", "rb", "qb", "id", "vec")
    one = base.where("asks").groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))
    asks = spread(one, "qb", query_blocks, "rb", row_blocks).select("dim", "rb", "qb", "id", "vec")
    keys = ["dim", "rb", "qb"]
    run = _search(k, trees, depth, share, seed)
    found = rows.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInPandas(
        lambda key, a, b: run(key, a[["id", "vec"]], b[["id", "vec"]]), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
