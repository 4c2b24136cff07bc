"""Query over the pluggable batch scorer (V1) on the frames table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.operators.filters import DetectionPolicy
from sightline.operators.scoring import StubScorer, detections_struct, score_frames
from sightline.operators.shapes import with_frame_shape
from sightline.plans.registry import query
from sightline.plans.sql_views import F_
from sightline.sources.tables import frames


def frame_payloads(f):
    """Frame bytes for the stub scorer: a JPEG start marker followed by
    ``frame_id % 7`` filler bytes (the test tables carry no images). Every
    11th frame has no such marker, so scoring it fails."""
    filler = F.encode(F.expr("repeat('x', CAST(pmod(frame_id, 7) AS INT))"), "UTF-8")
    start = F.when(F.col("frame_id") % 11 == 0, F.unhex(F.lit("0000"))).otherwise(F.unhex(F.lit("FFD8")))
    return f.withColumn("payload", F.concat(start, filler))


def two_class_scorer():
    return StubScorer(classes=2)


def scored(spark, sf):
    """Every frame scored: boxes of class 0 with a confidence of 0.6 or more
    stay; of a frame's 0.9 (class 0), 0.7 (class 1), 0.5 (class 0) the first."""
    f = frame_payloads(frames(spark, sf).select("camera_id", "frame_id", "ts"))
    return score_frames(f, two_class_scorer, DetectionPolicy(0.6, (0,)),
                        spread_over=spark.sparkContext.defaultParallelism)


SCORED_ = F_ + """, scored AS (
  SELECT camera_id, frame_id,
         CASE WHEN frame_id % 11 = 0 OR (2 + frame_id % 7) % 4 = 0 THEN 0 ELSE 1 END AS kept,
         CASE WHEN frame_id % 11 = 0 THEN 'ValueError: payload is not a JPEG image' END AS error
  FROM frames)
"""


@query("scored_frames", SCORED_ + """
SELECT camera_id, CAST(frame_id AS VARCHAR) AS frame_id, CAST(kept AS INTEGER) AS detection_count,
       CAST(0.9 * kept AS DOUBLE) AS total_confidence, error
FROM scored""")
def scored_frames(spark, sf):
    msgs = detections_struct(scored(spark, sf))
    return msgs.select("camera_id", "frame_id", "detection_count",
                       F.round(F.aggregate(F.transform("detections", lambda d: d["confidence"]),
                                           F.lit(0.0), lambda a, x: a + x), 6).alias("total_confidence"),
                       "error")


@query("error_split", SCORED_ + """
SELECT CASE WHEN error IS NULL THEN 'messages' ELSE 'errors' END AS output, camera_id,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(kept) AS BIGINT) AS n_detections
FROM scored GROUP BY 1, 2""")
def error_split(spark, sf):
    """messages and errors of the scored frames, counted per camera, on
    one pass over the frames."""
    output = F.when(F.col("error").isNull(), F.lit("messages")).otherwise(F.lit("errors"))
    return (detections_struct(scored(spark, sf)).groupBy(output.alias("output"), "camera_id")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("detection_count").cast("long").alias("n_detections")))


def jpeg_headers(f):
    """Frames whose payload is a JPEG header of their size, behind segments
    that grow with the id; every 11th is cut off in the middle."""
    def word(c):
        return F.lpad(F.hex(c.cast("long")), 4, "0")
    n = F.pmod(F.col("frame_id"), F.lit(40))
    filler = F.concat(F.lit("FFE0"), word(n + 2), F.repeat(F.lit("00"), n.cast("int")))
    header = F.concat(F.lit("FFC0001108"), word(F.col("height")), word(F.col("width")), F.lit("03"), F.repeat(F.lit("00"), 9))
    whole = F.concat(F.lit("FFD8"), filler, F.lit("FFFF"), F.substring(header, 3, 1000))
    cut = F.when(F.col("frame_id") % 11 == 0, F.substr(whole, F.lit(1), F.length(whole) - 34)).otherwise(whole)
    return f.withColumn("payload", F.unhex(cut))


@query("frame_shapes", F_ + """
SELECT frame_id, camera_id, CASE WHEN frame_id % 11 <> 0 THEN height + frame_id % 7 END AS h,
       CASE WHEN frame_id % 11 <> 0 THEN width + frame_id % 5 END AS w,
       CASE WHEN frame_id % 11 <> 0 THEN 3 END AS c FROM frames""")
def frame_shapes(spark, sf):
    """The shape that a frame's own header says; none if it is broken."""
    f = frames(spark, sf)
    f = f.select("frame_id", "camera_id", (F.col("height") + F.col("frame_id") % 7).alias("height"),
                 (F.col("width") + F.col("frame_id") % 5).alias("width"))
    s = with_frame_shape(jpeg_headers(f))
    return s.select("frame_id", "camera_id", *[F.get("frame_shape", i).alias(n) for i, n in enumerate(("h", "w", "c"))])
