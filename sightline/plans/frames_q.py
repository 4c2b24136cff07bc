"""Queries over frames and detections: filters, counts, buffers, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.operators import filters, stats
from sightline.operators.matching import class_name_lookup, frame_detection_join
from sightline.operators.sequence import running_total
from sightline.plans.registry import query
from sightline.plans.sql_views import F_, FD
from sightline.sources import files
from sightline.sources.tables import detection_arrivals, detections, frames
from sightline.streaming.joins import frame_detections
from sightline.streaming.stateful import event_time

# ---------------------------------------------------------------- counts


@query("detections_per_frame", FD + """
SELECT f.frame_id, f.camera_id, f.ts, CAST(count(d.det_seq) AS BIGINT) AS detection_count
FROM frames f LEFT JOIN detections d ON f.frame_id = d.frame_id
GROUP BY f.frame_id, f.camera_id, f.ts""")
def detections_per_frame(spark, sf):
    f = frames(spark, sf).select("frame_id", "camera_id", "ts")
    return stats.per_frame_counts(f, detections(spark, sf))


@query("empty_frames_kept", FD + """
SELECT f.frame_id, f.camera_id, f.ts FROM frames f
WHERE NOT EXISTS (SELECT 1 FROM detections d WHERE d.frame_id = f.frame_id)""")
def empty_frames_kept(spark, sf):
    f = frames(spark, sf).select("frame_id", "camera_id", "ts")
    return stats.empty_frames(f, detections(spark, sf))


_DET_COLS = "frame_id, camera_id, ts, det_seq, x1, y1, x2, y2, confidence, class_id"


@query("confidence_filter", FD + f"SELECT {_DET_COLS} FROM detections WHERE confidence >= 0.5")
def confidence_filter(spark, sf):
    return filters.confidence_filter(detections(spark, sf), 0.5)


@query("class_filter", FD + f"SELECT {_DET_COLS} FROM detections WHERE confidence >= 0.5 AND class_id = 0")
def class_filter(spark, sf):
    return filters.class_filter(detections(spark, sf), (filters.PERSON_CLASS,), 0.5)


@query("nonempty_detections", FD + """
SELECT frame_id, camera_id, CAST(count(*) AS BIGINT) AS detection_count
FROM detections WHERE confidence >= 0.5 AND class_id = 0 GROUP BY frame_id, camera_id""")
def nonempty_detections(spark, sf):
    kept = filters.class_filter(detections(spark, sf))
    return kept.groupBy("frame_id", "camera_id").agg(F.count(F.lit(1)).alias("detection_count"))


@query("stream_totals", FD + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM frames) AS total_frames,
       (SELECT CAST(count(*) AS BIGINT) FROM detections) AS total_detections""")
def stream_totals(spark, sf):
    return stats.stream_totals(frames(spark, sf).select("frame_id"),
                               detections(spark, sf).select("frame_id"))


@query("overall_rate", F_ + """
SELECT n_frames, first_ts, last_ts, elapsed_s,
       round(CASE WHEN elapsed_s > 0 THEN n_frames / elapsed_s ELSE 0 END, 9) AS frames_per_s
FROM (SELECT CAST(count(*) AS BIGINT) AS n_frames, min(ts) AS first_ts, max(ts) AS last_ts,
             (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS elapsed_s FROM frames)""")
def overall_rate(spark, sf):
    r = stats.overall_rate(frames(spark, sf).select("ts"))
    return r.withColumn("frames_per_s", F.round("frames_per_s", 9))


# ------------------------------------------------------ running sequences

def _day():
    """Sequence bucket: a camera's frames of one day. A camera cannot emit
    more than fps x 86400 frames a day, so a bucket stays bounded however
    much history the table holds."""
    return F.date_trunc("day", F.col("ts"))


def _running(spark, sf):
    f = frames(spark, sf).select("frame_id", "camera_id", "ts")
    counted = stats.per_frame_counts(f, detections(spark, sf).select("frame_id"))
    return stats.running_frame_stats(counted, ["camera_id"], ["ts", "frame_id"], _day())


_RUNNING_SQL = FD + """, counted AS (
  SELECT f.frame_id, f.camera_id, f.ts, CAST(count(d.det_seq) AS BIGINT) AS detection_count
  FROM frames f LEFT JOIN detections d ON f.frame_id = d.frame_id GROUP BY ALL),
running AS (
  SELECT frame_id, camera_id, ts, detection_count,
         CAST(row_number() OVER w AS BIGINT) AS frame_no,
         CAST(sum(detection_count) OVER w AS BIGINT) AS running_detections
  FROM counted WINDOW w AS (PARTITION BY camera_id ORDER BY ts, frame_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


@query("running_totals", _RUNNING_SQL + """
SELECT *, round(CASE WHEN epoch_us(ts) > epoch_us(min(ts) OVER (PARTITION BY camera_id))
                     THEN frame_no / ((epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY camera_id))) / 1e6) END, 12)
          AS running_fps
FROM running""")
def running_totals(spark, sf):
    """Frame number, detections and rate of each feed so far."""
    r = stats.running_rate(_running(spark, sf), ["camera_id"], "ts")
    return r.withColumn("running_fps", F.round("running_fps", 12))


@query("progress_rows", _RUNNING_SQL + "SELECT * FROM running WHERE frame_no % 20 = 0")
def progress_rows(spark, sf):
    return filters.every_nth(_running(spark, sf), 20, "frame_no")


@query("frame_skip", F_ + """
SELECT camera_id, frame_id, frame_no FROM (
  SELECT camera_id, frame_id,
         CAST(row_number() OVER (PARTITION BY camera_id ORDER BY frame_id) AS BIGINT) AS frame_no
  FROM frames) WHERE frame_no % 3 = 0""")
def frame_skip(spark, sf):
    f = frames(spark, sf).select("camera_id", "frame_id")
    numbered = running_total(f, ["camera_id"], ["frame_id"],
                             F.floor(F.col("frame_id") / 4096), None, "frame_no")
    return filters.every_nth(numbered, 3, "frame_no")


@query("retain_last_n", F_ + """
SELECT camera_id, frame_id, newest_rank FROM (
  SELECT camera_id, frame_id,
         CAST(row_number() OVER (PARTITION BY camera_id ORDER BY frame_id DESC) AS BIGINT) AS newest_rank
  FROM frames) WHERE newest_rank <= 100""")
def retain_last_n(spark, sf):
    f = frames(spark, sf).select("camera_id", "frame_id")
    return stats.keep_n(f, ["camera_id"], [F.col("frame_id").desc()], 100, "newest_rank")


# -------------------------------------------------------------- joins


# Fixed parameter (our choice): a detection arrives within 45 days of its frame.
ARRIVES_DAYS = 45


@query("frame_detection_interval", F_ + f"""
, d AS (SELECT l_orderkey AS frame_id, 'cam' || CAST(o_custkey % 7 + 1 AS VARCHAR) AS camera_id, l_shipdate AS det_ts,
               l_linenumber AS line, l_partkey AS part, l_suppkey AS supp FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT coalesce(f.frame_id, d.frame_id) AS frame_id, coalesce(f.camera_id, d.camera_id) AS camera_id, f.ts, f.width,
       d.det_ts, d.line, d.part, d.supp
FROM frames f FULL JOIN d ON f.frame_id = d.frame_id AND f.camera_id = d.camera_id
  AND d.det_ts BETWEEN f.ts AND f.ts + INTERVAL {ARRIVES_DAYS} DAY""")
def frame_detection_interval(spark, sf):
    """J2 with times, both sides kept: each frame with the detections that
    arrive in time, and once alone if none does; the same for detections."""
    f = event_time(frames(spark, sf).select("frame_id", "camera_id", "ts", "width"))
    d = event_time(detection_arrivals(spark, sf), "det_ts")
    out = frame_detections(f, d, within=f"{ARRIVES_DAYS} days", how="full_outer")
    back = [F.col(c).cast("timestamp_ntz").alias(c) if c in ("ts", "det_ts") else c for c in out.columns]
    return out.select(*back)


@query("frame_detection_join", FD + """
SELECT f.frame_id, f.camera_id, f.ts, f.width, f.height, d.det_seq, d.confidence, d.class_id
FROM frames f JOIN detections d ON f.frame_id = d.frame_id AND f.camera_id = d.camera_id""")
def frame_detection_join_q(spark, sf):
    d = detections(spark, sf).select("frame_id", "camera_id", "det_seq", "confidence", "class_id")
    return frame_detection_join(frames(spark, sf), d).select(
        "frame_id", "camera_id", "ts", "width", "height", "det_seq", "confidence", "class_id")


@query("class_name_lookup", FD + """
SELECT d.class_id, c.class_name, CAST(count(*) AS BIGINT) AS n_detections
FROM detections d JOIN (VALUES (0, 'person'), (1, 'bag'), (2, 'bicycle')) c(class_id, class_name)
  ON d.class_id = c.class_id
GROUP BY d.class_id, c.class_name""")
def class_name_lookup_q(spark, sf):
    counts = (detections(spark, sf).groupBy("class_id")
              .agg(F.count(F.lit(1)).alias("n_detections")))
    return class_name_lookup(spark, counts).select("class_id", "class_name", "n_detections")


# ------------------------------------------------------- feeds / files


@query("multi_camera_union", F_ + """
SELECT camera_id || '-frames' AS topic, camera_id, CAST(count(*) AS BIGINT) AS n_frames
FROM frames GROUP BY camera_id""")
def multi_camera_union(spark, sf):
    f = frames(spark, sf).select("camera_id")
    tagged = f.select(files.topic_of(F.col("camera_id"), "frames").alias("topic"))
    counts = tagged.groupBy("topic").agg(F.count(F.lit(1)).alias("n_frames"))
    return counts.select("topic", files.camera_of_topic(F.col("topic")).alias("camera_id"), "n_frames")


@query("history_scan_pruned", F_ + """
SELECT frame_id, camera_id, ts FROM frames
WHERE camera_id IN ('cam1', 'cam3') AND ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '1997-01-01'""")
def history_scan_pruned(spark, sf):
    f = frames(spark, sf).select("frame_id", "camera_id", "ts")
    return files.history_filter(f, ["cam1", "cam3"], "1996-01-01", "1997-01-01")


@query("missing_inputs_anti", F_ + """
, bounds AS (SELECT camera_id, min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1
             FROM frames GROUP BY camera_id),
expected AS (SELECT camera_id, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS day
             FROM bounds)
SELECT e.camera_id, e.day FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM frames f WHERE f.camera_id = e.camera_id AND CAST(f.ts AS DATE) = e.day)""")
def missing_inputs_anti(spark, sf):
    f = frames(spark, sf).select("camera_id", F.to_date("ts").alias("day"))
    return files.missing_expected(f, ["camera_id"], "day")
