"""Queries over appearance vectors: norms, re-id pairs, k-NN, identities."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sightline.functions.geometry import ground_x, ground_y
from sightline.operators import identity as ID
from sightline.operators import metric
from sightline.plans.registry import query
from sightline.plans.sql_views import S_, V_
from sightline.session import materialize, scratch_path
from sightline.sources.tables import sightings, vectors

_NORMS = V_ + """, normed AS (
  SELECT vec_id, camera_id, embedding,
         sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm
  FROM vectors)
"""

_SIM = """(list_sum(list_transform(list_zip(a.embedding, b.embedding),
             lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE))) / (a.norm * b.norm))"""


@query("embedding_normalize", _NORMS + """
SELECT vec_id, camera_id, round(norm, 6) AS norm,
       round(sqrt(list_sum(list_transform(embedding, lambda x: (CAST(x AS DOUBLE) / norm) * (CAST(x AS DOUBLE) / norm)))), 6)
         AS unit_norm
FROM normed""")
def embedding_normalize(spark, sf):
    v = vectors(spark, sf)
    return v.select("vec_id", "camera_id", F.round(ID.l2_norm(F.col("embedding")), 6).alias("norm"),
                    F.round(ID.l2_norm(ID.normalise(F.col("embedding"))), 6).alias("unit_norm"))


# Fixed parameters (our choice, FIXTURES §3): 0.3 for candidate pairs,
# 0.35 for identity components, k = 5 for search and 10 for re-ranking.
PAIR_T, COMPONENT_T, SEARCH_K, RERANK_K = 0.3, 0.35, 5, 10


def _pairs_sql(t: float) -> str:
    return f""", pairs AS (
  SELECT a.vec_id AS vec_id_a, b.vec_id AS vec_id_b, a.camera_id AS camera_id_a, b.camera_id AS camera_id_b,
         {_SIM} AS sim
  FROM normed a JOIN normed b ON a.vec_id < b.vec_id AND a.camera_id <> b.camera_id
  WHERE {_SIM} > {t})
"""


@query("reid_similarity_pairs", _NORMS + _pairs_sql(PAIR_T) + """
SELECT vec_id_a, vec_id_b, camera_id_a, camera_id_b, round(sim, 6) AS sim FROM pairs""")
def reid_similarity_pairs(spark, sf):
    p = ID.similar_pairs(vectors(spark, sf), "vec_id", "embedding", "camera_id", PAIR_T)
    return p.select("vec_id_a", "vec_id_b", "camera_id_a", "camera_id_b", F.round("sim", 6).alias("sim"))


def _knn_sql(k: int) -> str:
    return f""", half AS MATERIALIZED (
  SELECT a.vec_id AS a_id, b.vec_id AS b_id, {_SIM} AS sim FROM normed a JOIN normed b ON a.vec_id < b.vec_id),
both_ways AS (SELECT a_id AS vec_id, b_id AS nbr_id, sim FROM half UNION ALL SELECT b_id, a_id, sim FROM half),
knn AS MATERIALIZED (
  SELECT vec_id, nbr_id, sim, rank FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 9) DESC, nbr_id) AS BIGINT) AS rank
    FROM both_ways) WHERE rank <= {k})
"""


@query("embedding_topk", _NORMS + _knn_sql(SEARCH_K) + """
SELECT vec_id, rank, nbr_id, round(sim, 6) AS sim FROM knn""")
def embedding_topk(spark, sf):
    k = ID.top_k(vectors(spark, sf), "vec_id", "embedding", SEARCH_K)
    return k.select("vec_id", "rank", "nbr_id", F.round("sim", 6).alias("sim"))


@query("vector_search", _NORMS + _knn_sql(SEARCH_K) + """
SELECT vec_id, rank, nbr_id, round(sim, 6) AS sim FROM knn WHERE vec_id % 100 = 0""")
def vector_search(spark, sf):
    """The query set (ids that 100 divides) against all vectors."""
    v = vectors(spark, sf)
    s = ID.search(v, "vec_id", "embedding", v.where(F.col("vec_id") % 100 == 0), SEARCH_K)
    return s.select("vec_id", "rank", "nbr_id", F.round("sim", 6).alias("sim"))


@query("indexed_search", _NORMS + _knn_sql(SEARCH_K) + """
SELECT vec_id, rank, nbr_id, round(sim, 6) AS sim FROM knn WHERE vec_id % 100 = 0""")
def indexed_search(spark, sf):
    """V11/L5 over a stored index: built from all vectors, read by bounds."""
    v = vectors(spark, sf)
    s = metric.indexed_search(v, "vec_id", "embedding", v.where(F.col("vec_id") % 100 == 0), SEARCH_K)
    return s.select("vec_id", "rank", "nbr_id", F.round("sim", 6).alias("sim"))


@query("k_reciprocal", _NORMS + _knn_sql(RERANK_K) + """
SELECT f.vec_id AS a, f.nbr_id AS b, round(f.sim, 6) AS sim FROM knn f
JOIN knn r ON r.vec_id = f.nbr_id AND r.nbr_id = f.vec_id WHERE f.vec_id < f.nbr_id""")
def k_reciprocal(spark, sf):
    k = ID.top_k(vectors(spark, sf), "vec_id", "embedding", RERANK_K)
    return ID.k_reciprocal(k).select("a", "b", F.round("sim", 6).alias("sim"))


@query("rerank_jaccard", _NORMS + _knn_sql(RERANK_K) + """
, sizes AS (SELECT vec_id, count(*) AS size FROM knn GROUP BY vec_id),
shared AS (SELECT p.vec_id, p.nbr_id, count(*) AS inter FROM knn p
           JOIN knn na ON na.vec_id = p.vec_id JOIN knn nb ON nb.vec_id = p.nbr_id AND nb.nbr_id = na.nbr_id
           GROUP BY p.vec_id, p.nbr_id)
SELECT p.vec_id, p.nbr_id, p.rank, CAST(coalesce(s.inter, 0) AS BIGINT) AS shared,
       round(coalesce(s.inter, 0) / (sa.size + coalesce(sb.size, 0) - coalesce(s.inter, 0)), 6) AS jaccard
FROM knn p LEFT JOIN shared s ON s.vec_id = p.vec_id AND s.nbr_id = p.nbr_id
JOIN sizes sa ON sa.vec_id = p.vec_id LEFT JOIN sizes sb ON sb.vec_id = p.nbr_id""")
def rerank_jaccard(spark, sf):
    k = ID.top_k(vectors(spark, sf), "vec_id", "embedding", RERANK_K)
    j = ID.jaccard_rerank(k)
    return j.select("vec_id", "nbr_id", "rank", "shared", F.round("jaccard", 6).alias("jaccard"))


_COMPONENTS_SQL = "WITH RECURSIVE " + _NORMS[len("WITH "):] + _pairs_sql(COMPONENT_T) + """
, und AS (SELECT vec_id_a AS a, vec_id_b AS b FROM pairs UNION SELECT vec_id_b, vec_id_a FROM pairs),
reach(v, r) AS (SELECT vec_id, vec_id FROM vectors
                UNION SELECT reach.v, und.b FROM reach JOIN und ON reach.r = und.a),
comp AS (SELECT v AS vec_id, min(r) AS global_id FROM reach GROUP BY v)
"""


def _components(spark, sf):
    v = vectors(spark, sf)
    # the pairs feed the component rounds and the confidence: compute once
    pairs = materialize(ID.similar_pairs(v, "vec_id", "embedding", "camera_id", COMPONENT_T), "pairs")
    return ID.global_ids(v, pairs), pairs


@query("global_ids", _COMPONENTS_SQL + "SELECT vec_id, global_id FROM comp")
def global_ids(spark, sf):
    comp, _ = _components(spark, sf)
    return comp


@query("global_ids_growing", _COMPONENTS_SQL + "SELECT vec_id, global_id FROM comp")
def global_ids_growing(spark, sf):
    """V4 as links arrive: three batches into a stored table give what all
    links give at once."""
    v = vectors(spark, sf)
    pairs = materialize(ID.similar_pairs(v, "vec_id", "embedding", "camera_id", COMPONENT_T), "pairs")
    grown = ID.GrowingIdentities(spark, scratch_path(spark, f"tables/identities-{uuid.uuid4().hex}"))
    for i in range(3):
        grown.add(pairs.where(F.pmod(F.xxhash64("vec_id_a", "vec_id_b"), F.lit(3)) == i), "vec_id_a", "vec_id_b", "links", i)
    return (v.select("vec_id").join(grown.labels("vec_id"), "vec_id", "left")
            .select("vec_id", F.coalesce("global_id", "vec_id").alias("global_id")))


@query("global_id_confidence", _COMPONENTS_SQL + """
, inc AS (SELECT vec_id_a AS vec_id, sim FROM pairs UNION ALL SELECT vec_id_b, sim FROM pairs)
SELECT c.vec_id, c.global_id, CAST(count(i.sim) AS BIGINT) AS n_edges,
       round(min(i.sim), 6) AS min_sim, round(avg(i.sim), 6) AS avg_sim
FROM comp c LEFT JOIN inc i ON c.vec_id = i.vec_id GROUP BY c.vec_id, c.global_id""")
def global_id_confidence(spark, sf):
    comp, pairs = _components(spark, sf)
    c = ID.assignment_confidence(comp, pairs)
    return c.select("vec_id", "global_id", "n_edges", F.round("min_sim", 6).alias("min_sim"),
                    F.round("avg_sim", 6).alias("avg_sim"))


# Fixed parameters (our choice): a week between two sightings, and a walk of
# at most 0.0002 m/s between their places.
GATE_DAYS, GATE_VMAX = 7, 0.0002
_GX = "(-3.0 + 0.025 * ({p} % 480))"
_GY = "(-9.0 + 0.025 * floor({p} / 480))"


@query("gated_identity_pairs", _NORMS + _pairs_sql(PAIR_T) + ", " + S_.strip()[len("WITH "):] + f"""
, g AS (SELECT p.vec_id_a, p.vec_id_b, p.sim, abs(epoch_us(b.ts) - epoch_us(a.ts)) / 1e6 AS dt_s,
               sqrt(power({_GX.format(p='b.position_id')} - {_GX.format(p='a.position_id')}, 2)
                  + power({_GY.format(p='b.position_id')} - {_GY.format(p='a.position_id')}, 2)) AS dist_m
        FROM pairs p JOIN sightings a ON a.event_id = p.vec_id_a JOIN sightings b ON b.event_id = p.vec_id_b)
SELECT vec_id_a, vec_id_b, round(sim, 6) AS sim, round(dt_s, 6) AS dt_s, round(dist_m, 6) AS dist_m
FROM g WHERE dt_s > 0 AND dt_s <= {GATE_DAYS * 86400} AND dist_m <= {GATE_VMAX} * dt_s""")
def gated_identity_pairs(spark, sf):
    """J7 on candidates: pairs of similar vectors on different cameras whose
    sightings (a vector's id is its sighting's) one person could both have
    made. The sightings join the vectors, which are few, not the pairs."""
    v = metric.usable(vectors(spark, sf).where("vec_id IS NOT NULL"), "embedding")
    s = sightings(spark, sf).select(F.col("event_id").alias("vec_id"), "ts", F.col("position_id").alias("place"))
    # a pair without both times and places passes no gate
    v = v.join(s.where("ts IS NOT NULL AND place IS NOT NULL"), "vec_id").withColumn(
        "us", F.unix_micros(F.col("ts").cast("timestamp")))
    pairs = ID.similar_pairs(v, "vec_id", "embedding", "camera_id", PAIR_T, carry=("us", "place"))
    dt = F.abs(F.col("us_b") - F.col("us_a")) / 1e6
    dx = ground_x(F.col("place_b")) - ground_x(F.col("place_a"))
    dy = ground_y(F.col("place_b")) - ground_y(F.col("place_a"))
    g = pairs.withColumn("dt_s", dt).withColumn("dist_m", F.sqrt(dx * dx + dy * dy))
    g = g.where((F.col("dt_s") > 0) & (F.col("dt_s") <= GATE_DAYS * 86400)
                & (F.col("dist_m") <= GATE_VMAX * F.col("dt_s")))
    return g.select("vec_id_a", "vec_id_b", F.round("sim", 6).alias("sim"), F.round("dt_s", 6).alias("dt_s"),
                    F.round("dist_m", 6).alias("dist_m"))
