"""The adapter views of ``sources.tables`` written as portable SQL.

Oracle queries run in a separate engine over the raw test tables, so
each one inlines the views it needs as CTEs.
"""

FRAMES = """frames AS (
  SELECT o_orderkey AS frame_id, 'cam' || CAST(o_custkey % 7 + 1 AS VARCHAR) AS camera_id,
         o_orderdate AS ts, 1920 AS width, 1080 AS height
  FROM orders)"""

DETECTIONS = """detections AS (
  SELECT f.frame_id, f.camera_id, f.ts,
         CAST(row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS BIGINT) AS det_seq,
         CAST((l_partkey % 12) * 15 AS DOUBLE) AS x1,
         CAST((l_suppkey % 6) * 20 AS DOUBLE) AS y1,
         CAST((l_partkey % 12) * 15 AS DOUBLE) + 20 + l_quantity AS x2,
         CAST((l_suppkey % 6) * 20 AS DOUBLE) + 2 * (20 + l_quantity) AS y2,
         CAST(round(l_discount * 100) AS INT) / CAST(10 AS DOUBLE) AS confidence,
         CAST((l_linenumber - 1) % 3 AS INT) AS class_id
  FROM lineitem JOIN frames f ON l_orderkey = f.frame_id)"""

SIGHTINGS = """sightings AS (
  SELECT event_id, 'P' || CAST(user_id AS VARCHAR) AS global_id,
         CASE event_type WHEN 'signup' THEN 'cam1' WHEN 'view' THEN 'cam2' WHEN 'click' THEN 'cam3'
                         WHEN 'purchase' THEN 'cam4' ELSE 'cam5' END AS camera_id,
         ts, value / 500 AS confidence, CAST((event_id * 7919) % 691200 AS INT) AS position_id
  FROM events)"""

VECTORS = """vectors AS (
  SELECT vec_id, 'cam' || CAST(vec_id % 7 + 1 AS VARCHAR) AS camera_id, embedding FROM embeddings)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


FD = with_views(FRAMES, DETECTIONS)
F_ = with_views(FRAMES)
S_ = with_views(SIGHTINGS)
V_ = with_views(VECTORS)
