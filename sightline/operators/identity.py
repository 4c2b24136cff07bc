"""Appearance vectors: normalisation, similarity pairs, k-NN, re-ranking,
global identities (T19, L5, V3-V6, V11).

Pairs over a threshold come from ``metric.near_pairs``, which compares only
what the angles to pivots allow. The k nearest of every vector (``top_k``)
need every pair's dot product, but never a
group holding all vectors, nor copies of them: vectors are packed into blocks
of about ``tile_size`` rows, written once to the shared folder, and tasks read
pairs of blocks there (``metric.block_pairs``), multiply their matrices with
numpy and keep each row's top k. A bounded query set needs no shuffle (``search``), and a stored index
is searched by its bounds (``metric.search_index``).

Vectors without a direction (null, empty, zero, null or non-finite
components), of another than the usual length, or without an id take no
part in any of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.graph import component_labels, connected_components
from sightline.operators.metric import block_pairs, blocks, has_direction, near_pairs, unit, unpacked, usable
from sightline.operators.stats import keep_n
from sightline.session import materialize
from sightline.sources.versions import VersionedTable


def sq_norm(v: Column) -> Column:
    """Sum of squares in double, in array order."""
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def l2_norm(v: Column) -> Column:
    return F.sqrt(sq_norm(v))


def normalise(v: Column) -> Column:
    """Unit-length vector (zero vectors stay zero)."""
    n = l2_norm(v)
    return F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def dot(a: Column, b: Column) -> Column:
    """Dot product in double, in array order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def similar_pairs(vecs: DataFrame, id_col: str, vec_col: str, group_col: str | None,
                  threshold: float, tile_size: int = 2048, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every pair (a < b) with cosine > threshold; with ``group_col``
    only pairs from different groups (different cameras). See
    ``metric.near_pairs``."""
    return near_pairs(vecs, id_col, vec_col, group_col, threshold, tile_size, carry=carry)


def top_k(vecs: DataFrame, id_col: str, vec_col: str, k: int, tile_size: int = 2048,
          queries: DataFrame | None = None) -> DataFrame:
    """The k most similar other vectors of every vector (or of every
    row of ``queries``), ordered by similarity (rounded to 1e-9) desc, then
    neighbour id asc. Every row with the vector's own id is left out before
    the k are taken, so repeated ids leave k.

    Blocks of queries stream past the blocks of vectors (``metric.blocks``):
    a task holds one pair of blocks and the best k so far of one block's
    queries, and hands those on; a global top-k per query (with a partial
    window-group limit) merges what the tasks found.
    """
    v = vecs.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"), F.lit(False).alias("_q"))
    if queries is not None:
        v = v.unionByName(queries.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"),
                                         F.lit(True).alias("_q")))
    v = materialize(usable(v.where("_id IS NOT NULL"), "_v"), "vectors")

    def cut(rows: DataFrame) -> DataFrame:
        one = rows.withColumn("_cell", F.lit(0))
        return blocks(one, [(0, rows.count())], tile_size, ["_id"]).select("_no", "_unit", "_id")
    asked = cut(v.where("_q")) if queries is not None else None
    corpus = cut(v.where("NOT _q"))
    id_type = vecs.schema[id_col].dataType.simpleString()

    def run(batches):
        no, best = None, []
        for batch in batches:
            for r in batch.to_dict("records"):
                x, y = (unpacked(r[p + "_unit"], len(r[p + "_id"])) for p in "ab")
                q_ids, c_ids = np.asarray(r["a_id"]), np.asarray(r["b_id"])
                if no != r["a_no"]:
                    yield from best
                    no, best = r["a_no"], [None] * -(-len(q_ids) // _ROWS)
                for i, at in enumerate(range(0, len(q_ids), _ROWS)):
                    best[i] = _better(best[i], x[at:at + _ROWS], q_ids[at:at + _ROWS], y, c_ids, k)
        yield from best

    both = block_pairs(corpus if asked is None else asked, corpus)
    out = both.select("a_no", "a_unit", "b_unit", "a_id", "b_id").mapInPandas(
        run, f"at long, q {id_type}, n {id_type}, sim double").withColumn("_s9", F.round("sim", 9))
    ranked = keep_n(out.drop("at"), ["q"], [F.col("_s9").desc(), F.col("n")], k, "rank")
    return ranked.select(F.col("q").alias(id_col), "rank", F.col("n").alias("nbr_id"), "sim")


#: Queries that are compared with a block at once.
_ROWS = 512


def _better(best: pd.DataFrame | None, x: np.ndarray, q_ids: np.ndarray, y: np.ndarray, c_ids: np.ndarray,
            k: int) -> pd.DataFrame:
    """The k best of each query (row ``at`` of ``x``) among ``best`` and the
    rows of ``y``. A row that falls short of the query's k-th best so far, or
    of the block's, is not looked at; ties are."""
    s = x @ y.T
    s[q_ids[:, None] == c_ids[None, :]] = -np.inf
    least = np.full(len(x), -np.inf)
    if best is not None:
        place = best.groupby("at").cumcount().to_numpy()
        least[best["at"].to_numpy()[place == k - 1]] = best["sim"].to_numpy()[place == k - 1]
    few = np.flatnonzero(np.isneginf(least))
    if len(few) and s.shape[1] > k:
        least[few] = np.partition(s[few], -k, axis=1)[:, -k]
    # similarities equal in nine places may differ by as much
    r, c = np.nonzero((s >= least[:, None] - 2e-9) & np.isfinite(s))
    found = pd.DataFrame({"at": r, "q": q_ids[r], "n": c_ids[c], "sim": s[r, c]})
    if best is not None and len(best):
        found = pd.concat([best, found], ignore_index=True) if len(found) else best
    order = np.lexsort((found["n"].to_numpy(), -np.round(found["sim"].to_numpy(), 9), found["at"].to_numpy()))
    found = found.iloc[order]
    return found[(found.groupby("at").cumcount() < k).to_numpy()]


def search(vecs: DataFrame, id_col: str, vec_col: str, queries: DataFrame, k: int,
           most_queries: int = 4096, tile_size: int = 2048) -> DataFrame:
    """The k most similar vectors of each query row, the query's own id
    left out, ordered as in ``top_k``.

    Up to ``most_queries`` query rows (counted first) travel to the tasks and
    the corpus streams past them where it lies: it is not shuffled, and a
    task hands on k rows a query at most. More queries than that go through
    the tiles of ``top_k``; both ways give the same rows."""
    rows = usable(vecs.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v")).where("_id IS NOT NULL"), "_v")
    q = queries.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"))
    got = q.where(has_direction(F.col("_v")) & F.col("_id").isNotNull()).limit(most_queries + 1).toPandas()
    if len(got) > most_queries:
        return top_k(vecs, id_col, vec_col, k, tile_size, queries)
    q_ids, q_vecs = got["_id"].to_numpy(), list(got["_v"])
    id_type = vecs.schema[id_col].dataType.simpleString()

    def run(batches):
        q_unit = None
        ids = sims = None
        for b in batches:
            if not len(b) or not len(q_ids):
                continue
            x = unit(b["_v"])
            if q_unit is None:
                fits = np.array([len(v) == x.shape[1] for v in q_vecs])
                q_unit = np.zeros((len(q_ids), x.shape[1]))
                if fits.any():
                    q_unit[fits] = unit([v for v, ok in zip(q_vecs, fits) if ok])
                ids = np.zeros((len(q_ids), 0), dtype=b["_id"].to_numpy().dtype)
                sims = np.zeros((len(q_ids), 0))
            for at in range(0, len(b), 1024):
                c = b["_id"].to_numpy()[at:at + 1024]
                s = q_unit @ x[at:at + 1024].T
                s[~fits] = -np.inf
                s[q_ids[:, None] == c[None, :]] = -np.inf
                # the k best of this block, ties at the cut included, then those of both
                s9 = np.round(s, 9)
                if s.shape[1] > k:
                    s[s9 < np.partition(s9, -k, axis=1)[:, -k][:, None]] = -np.inf
                r, j = np.nonzero(np.isfinite(s))
                pr, pj = np.nonzero(np.isfinite(sims))
                row, n, sim = np.concatenate([pr, r]), np.concatenate([ids[pr, pj], c[j]]), np.concatenate([sims[pr, pj], s[r, j]])
                order = np.lexsort((n, -np.round(sim, 9), row))
                row, n, sim = row[order], n[order], sim[order]
                place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
                row, n, sim, place = (v[place < k] for v in (row, n, sim, place))
                ids, sims = np.zeros((len(q_ids), k), dtype=ids.dtype), np.full((len(q_ids), k), -np.inf)
                ids[row, place], sims[row, place] = n, sim
        if sims is not None:
            r, c = np.nonzero(np.isfinite(sims))
            yield pd.DataFrame({"q": q_ids[r], "n": ids[r, c], "sim": sims[r, c]})
    found = rows.mapInPandas(
        run, f"q {id_type}, n {id_type}, sim double").withColumn("_s9", F.round("sim", 9))
    return keep_n(found, ["q"], [F.col("_s9").desc(), F.col("n")], k, "rank").select(
        F.col("q").alias(id_col), "rank", F.col("n").alias("nbr_id"), "sim")


def k_reciprocal(knn: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """V6: pairs that are in each other's k-NN lists (a < b).

    Each list entry votes for its unordered pair; a pair with two votes is
    mutual. One aggregation over groups of at most two rows, no self-join.
    """
    a, b = F.col(id_col), F.col("nbr_id")
    g = (knn.groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
         .agg(F.count(F.lit(1)).alias("_votes"), F.max("sim").alias("sim")))
    return g.where(F.col("_votes") == 2).select("a", "b", "sim")


def jaccard_rerank(knn: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """V6: Jaccard overlap of the neighbour sets of each (vector, neighbour).

    |N(a) & N(b)| counts the shared neighbours through an equi-join on the
    neighbour id restricted to (a, b) list pairs; |N(a) | N(b)| follows from
    the list sizes.
    """
    knn = materialize(knn.select(id_col, "nbr_id", "rank"), "knn")   # read four times below
    lists = knn.select(F.col(id_col).alias("v"), F.col("nbr_id").alias("n"))
    sizes = lists.groupBy("v").agg(F.count(F.lit(1)).alias("size"))
    pairs = knn.select(F.col(id_col).alias("a"), F.col("nbr_id").alias("b"), "rank")
    # (a, b, n) for every neighbour n of a; keep those that are also b's
    an = pairs.join(lists.withColumnRenamed("v", "a"), "a")
    shared = (an.join(lists.withColumnRenamed("v", "b"), ["b", "n"], "left_semi")
              .groupBy("a", "b").agg(F.count(F.lit(1)).alias("inter")))
    j = (pairs.join(shared, ["a", "b"], "left")
         .withColumn("inter", F.coalesce("inter", F.lit(0)))
         .join(sizes.select(F.col("v").alias("a"), F.col("size").alias("sa")), "a")
         .join(sizes.select(F.col("v").alias("b"), F.col("size").alias("sb")), "b", "left")
         .withColumn("sb", F.coalesce("sb", F.lit(0))))
    union = F.col("sa") + F.col("sb") - F.col("inter")
    return j.select(F.col("a").alias(id_col), F.col("b").alias("nbr_id"), "rank",
                    F.col("inter").cast("long").alias("shared"),
                    (F.col("inter") / union).alias("jaccard"))


def global_ids(vecs: DataFrame, pairs: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """V4: one identity per connected component of the similarity graph,
    named by its least member id."""
    return connected_components(vecs.select(id_col), pairs, id_col,
                                src=id_col + "_a", dst=id_col + "_b", out="global_id")


class GrowingIdentities:
    """V4 for links that arrive over time: a stored table of (id, identity,
    turn), to which a batch of links adds only the rows that change.

    The ends of new links are replaced by their identities so far; components
    of this small graph of identities say which of them are one. As every
    identity bears its least member's id, the least of the joined ones is
    the least member of all. Members whose identity changes are written
    again, members of other identities are not touched. The last row of an
    id counts; ``compact`` drops the others. Any split of the links into
    batches gives the identities of all links at once.
    """

    def __init__(self, spark, path: str):
        self.table = VersionedTable(spark, path)

    def labels(self, id_col: str = "id", out: str = "global_id") -> DataFrame:
        """Every id that had a link to another id, with its identity."""
        return _last_turn(self.table.read()).select(F.col("id").alias(id_col), F.col("identity").alias(out))

    def add(self, links: DataFrame, src: str, dst: str, query: str | None = None, batch_id: int | None = None) -> bool:
        """Merge a batch of links; False if this batch was merged before."""
        m = self.table.manifest()
        if query is not None and m["queries"].get(query, -1) >= batch_id:
            return False
        e = (links.select(F.col(src).alias("a"), F.col(dst).alias("b"))
             .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct())
        e = materialize(e, "new-links")
        ends = e.select(F.col("a").alias("id")).union(e.select(F.col("b").alias("id"))).distinct()
        if m["schema"] is None:
            known = ends.limit(0).select("id", F.col("id").alias("identity"))
        else:
            known = _last_turn(self.table.read()).select("id", "identity")
        known = materialize(known, "identities")
        of = materialize(ends.join(known, "id", "left"), "ends")
        name = of.select("id", F.coalesce("identity", "id").alias("name"))
        named = (e.join(name.select(F.col("id").alias("a"), F.col("name").alias("na")), "a")
                 .join(name.select(F.col("id").alias("b"), F.col("name").alias("nb")), "b"))
        joined = materialize(component_labels(named, "na", "nb").where("v <> component"), "joined")
        changed = known.join(joined, known["identity"] == joined["v"]).select("id", F.col("component").alias("identity"))
        new = (of.where("identity IS NULL").join(joined, of["id"] == joined["v"], "left")
               .select("id", F.coalesce("component", "id").alias("identity")))
        turn = F.lit(m["version"] + 1).cast("long").alias("turn")
        return self.table.append(changed.unionByName(new).select("id", "identity", turn), query, batch_id)

    def compact(self) -> bool:
        return self.table.compact(merge=_last_turn)


def _last_turn(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(F.max_by("identity", "turn").alias("identity"), F.max("turn").alias("turn"))


def assignment_confidence(comp: DataFrame, pairs: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """V5: per member, the number, minimum and mean similarity of its edges."""
    inc = (pairs.select(F.col(id_col + "_a").alias(id_col), "sim")
           .unionByName(pairs.select(F.col(id_col + "_b").alias(id_col), "sim")))
    st = inc.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_edges"), F.min("sim").alias("min_sim"),
                                 F.avg("sim").alias("avg_sim"))
    return (comp.join(st, id_col, "left")
            .withColumn("n_edges", F.coalesce("n_edges", F.lit(0)).cast("long")))

