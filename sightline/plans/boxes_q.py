"""Queries over boxes: geometry, annotation text, IoU, NMS, tracks, eval."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.functions import geometry as G
from sightline.functions import text as TX
from sightline.operators import assignment, boxes, stats
from sightline.operators.graph import chain_heads
from sightline.operators.matching import CLASS_NAMES
from sightline.operators.sequence import running_total, with_neighbor
from sightline.plans.registry import query
from sightline.plans.sql_views import FD
from sightline.session import materialize
from sightline.sources.tables import detections, frames, table


def iou_sql(a: str, b: str) -> str:
    """IoU of boxes ``a.x1..a.y2`` and ``b.x1..b.y2`` as SQL text."""
    inter = (f"greatest(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1), 0) * "
             f"greatest(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1), 0)")
    area_a = f"greatest({a}.x2 - {a}.x1, 0) * greatest({a}.y2 - {a}.y1, 0)"
    area_b = f"greatest({b}.x2 - {b}.x1, 0) * greatest({b}.y2 - {b}.y1, 0)"
    union = f"({area_a} + {area_b} - {inter})"
    return f"(CASE WHEN {union} > 0 THEN ({inter}) / {union} ELSE 0.0 END)"


def class_name_expr(col: str = "class_id"):
    e = F.lit(None).cast("string")
    for k, v in sorted(CLASS_NAMES.items(), reverse=True):
        e = F.when(F.col(col) == k, F.lit(v)).otherwise(e)
    return e


_CLASS_SQL = ("CASE class_id " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in sorted(CLASS_NAMES.items()))
              + " END")

# ------------------------------------------------------------ geometry


@query("resize_geometry", """
SELECT p_partkey, w, h,
       CASE WHEN w > 640 OR h > 480 THEN CAST(trunc(w * least(640.0 / w, 480.0 / h)) AS INTEGER) ELSE w END AS new_w,
       CASE WHEN w > 640 OR h > 480 THEN CAST(trunc(h * least(640.0 / w, 480.0 / h)) AS INTEGER) ELSE h END AS new_h
FROM (SELECT p_partkey, p_size * 60 AS w, p_size * 40 AS h FROM part)""")
def resize_geometry(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 60).alias("w"),
                                        (F.col("p_size") * 40).alias("h"))
    nw, nh = G.fit_inside(F.col("w"), F.col("h"))
    return p.select("p_partkey", "w", "h", nw.alias("new_w"), nh.alias("new_h"))


@query("rescale_boxes", FD + """
SELECT frame_id, det_seq, round(x1 * 3.0, 6) AS rx1, round(y1 * 3.0, 6) AS ry1,
       round(x2 * 3.0, 6) AS rx2, round(y2 * 3.0, 6) AS ry2 FROM detections""")
def rescale_boxes(spark, sf):
    """Boxes found on the 640x360 detector input, drawn on 1920x1080."""
    d = detections(spark, sf)
    sw, dw, sh, dh = F.lit(640), F.lit(1920), F.lit(360), F.lit(1080)
    return d.select("frame_id", "det_seq",
                    F.round(G.rescale(F.col("x1"), sw, dw), 6).alias("rx1"),
                    F.round(G.rescale(F.col("y1"), sh, dh), 6).alias("ry1"),
                    F.round(G.rescale(F.col("x2"), sw, dw), 6).alias("rx2"),
                    F.round(G.rescale(F.col("y2"), sh, dh), 6).alias("ry2"))


# Fixed values (our choice): label text cell of 9 px per character, 15 px
# high, 4 px below its base line. Fixed gap of the feed's label: 5 px.
CHAR_W, TEXT_H, TEXT_BASE, FEED_GAP = 9, 15, 4, 5


@query("annotation_rows", FD + f"""
, t AS (SELECT frame_id, det_seq,
               CAST(trunc(x1) AS INTEGER) AS ix1, CAST(trunc(y1) AS INTEGER) AS iy1,
               CAST(trunc(x2) AS INTEGER) AS ix2, CAST(trunc(y2) AS INTEGER) AS iy2,
               printf('%s: %.2f', {_CLASS_SQL}, confidence) AS label,
               printf('%s: %.3f', {_CLASS_SQL}, confidence) AS page_label
        FROM detections),
u AS (SELECT *, CASE WHEN iy1 - 10 > 10 THEN iy1 - 10 ELSE iy1 + {TEXT_H} + 10 END AS page_label_y FROM t)
SELECT frame_id, det_seq, ix1, iy1, ix2, iy2,
       label, iy1 - {FEED_GAP} AS label_y,
       iy1 - {TEXT_H} - 10 AS bg_y1, ix1 + {CHAR_W} * CAST(length(label) AS INTEGER) AS bg_x2, iy1 AS bg_y2,
       page_label, page_label_y, page_label_y - {TEXT_H} - {TEXT_BASE} AS page_bg_y1,
       ix1 + {CHAR_W} * CAST(length(page_label) AS INTEGER) AS page_bg_x2, page_label_y + {TEXT_BASE} AS page_bg_y2
FROM u""")
def annotation_rows(spark, sf):
    """Box corners and both label layouts, each whole: the feed's (two
    digits, always above the box) and the page's (three digits, below the
    top edge where there is no room above). A background starts at the box's
    left edge and holds its text."""
    d = detections(spark, sf)
    t = d.select("frame_id", "det_seq",
                 *[G.truncate_int(F.col(c)).alias("i" + c) for c in ("x1", "y1", "x2", "y2")],
                 TX.label_text(class_name_expr(), F.col("confidence")).alias("label"),
                 TX.label_text(class_name_expr(), F.col("confidence"), 3).alias("page_label"))
    t = t.withColumn("page_label_y", G.label_row(F.col("iy1"), TEXT_H))

    def right(label):
        return F.col("ix1") + CHAR_W * F.length(label)
    return t.select("frame_id", "det_seq", "ix1", "iy1", "ix2", "iy2",
                    "label", (F.col("iy1") - FEED_GAP).alias("label_y"),
                    (F.col("iy1") - TEXT_H - 10).alias("bg_y1"), right("label").alias("bg_x2"),
                    F.col("iy1").alias("bg_y2"),
                    "page_label", "page_label_y", (F.col("page_label_y") - TEXT_H - TEXT_BASE).alias("page_bg_y1"),
                    right("page_label").alias("page_bg_x2"), (F.col("page_label_y") + TEXT_BASE).alias("page_bg_y2"))


@query("annotation_file_names", FD + """
, counted AS (SELECT f.frame_id, f.camera_id, f.ts, count(d.det_seq) AS n
              FROM frames f LEFT JOIN detections d ON f.frame_id = d.frame_id GROUP BY ALL),
numbered AS (SELECT camera_id, frame_id, n,
                    row_number() OVER (PARTITION BY camera_id ORDER BY ts, frame_id) AS frame_no FROM counted)
SELECT camera_id, frame_id, printf('annotated_frame_%06d.jpg', frame_no) AS file_name
FROM numbered WHERE n > 0""")
def annotation_file_names(spark, sf):
    """K8: one numbered file per processed frame that has detections; the
    number is the frame's running position in its feed."""
    f = frames(spark, sf).select("frame_id", "camera_id", "ts")
    counted = stats.per_frame_counts(f, detections(spark, sf).select("frame_id"))
    numbered = running_total(counted, ["camera_id"], ["ts", "frame_id"],
                             F.date_trunc("day", "ts"), None, "frame_no")
    return (numbered.where(F.col("detection_count") > 0)
            .select("camera_id", "frame_id", TX.file_name(F.col("frame_no")).alias("file_name")))


@query("detection_report_lines", FD + """
SELECT frame_id, det_seq,
       printf('  Person %d: bbox=(%.0f,%.0f,%.0f,%.0f), conf=%.3f', det_seq + 1, x1, y1, x2, y2, confidence) AS line
FROM detections""")
def detection_report_lines(spark, sf):
    d = detections(spark, sf)
    return d.select("frame_id", "det_seq",
                    TX.report_line(F.col("det_seq") + 1, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"),
                                   F.col("confidence")).alias("line"))


@query("detections_rounded", FD + """
SELECT frame_id, det_seq, round(x1 / 3, 2) AS x1, round(y1 / 3, 2) AS y1, round(x2 / 3, 2) AS x2,
       round(y2 / 3, 2) AS y2, round(confidence, 2) AS confidence FROM detections""")
def detections_rounded(spark, sf):
    """Variant-B message values: boxes on the 640x360 input, 2 places."""
    d = detections(spark, sf)
    return d.select("frame_id", "det_seq", *[TX.round2(F.col(c) / 3).alias(c) for c in ("x1", "y1", "x2", "y2")],
                    TX.round2(F.col("confidence")).alias("confidence"))


# ---------------------------------------------------------- pair work


@query("iou_pairs", FD + f"""
SELECT a.frame_id, a.det_seq AS det_a, b.det_seq AS det_b, round({iou_sql('a', 'b')}, 6) AS iou
FROM detections a JOIN detections b ON a.frame_id = b.frame_id AND a.det_seq < b.det_seq
WHERE {iou_sql('a', 'b')} > 0""")
def iou_pairs(spark, sf):
    d = detections(spark, sf).select("frame_id", "det_seq", "x1", "y1", "x2", "y2")
    p = boxes.iou_pairs(d, ["frame_id"])
    return p.select(F.col("a_frame_id").alias("frame_id"), F.col("a_det_seq").alias("det_a"),
                    F.col("b_det_seq").alias("det_b"), F.round("iou", 6).alias("iou"))


@query("nms_per_frame", "WITH RECURSIVE " + FD[len("WITH "):] + f"""
, ranked AS (SELECT frame_id, camera_id, det_seq, confidence, x1, y1, x2, y2,
                    row_number() OVER (PARTITION BY frame_id ORDER BY confidence DESC, det_seq) AS rk
             FROM detections),
greedy(frame_id, rk, kept) AS (
  SELECT frame_id, rk, [struct_pack(det_seq := det_seq, x1 := x1, y1 := y1, x2 := x2, y2 := y2)]
  FROM ranked WHERE rk = 1
  UNION ALL
  SELECT r.frame_id, r.rk,
         CASE WHEN len(list_filter(g.kept, lambda k: {iou_sql('k', 'r')} > 0.5)) > 0 THEN g.kept
              ELSE list_append(g.kept, struct_pack(det_seq := r.det_seq, x1 := r.x1, y1 := r.y1, x2 := r.x2, y2 := r.y2))
         END
  FROM greedy g JOIN ranked r ON r.frame_id = g.frame_id AND r.rk = g.rk + 1),
final AS (SELECT g.frame_id, unnest(g.kept).det_seq AS det_seq FROM greedy g
          JOIN (SELECT frame_id, max(rk) AS rk FROM ranked GROUP BY frame_id) m
            ON g.frame_id = m.frame_id AND g.rk = m.rk)
SELECT d.frame_id, d.camera_id, d.det_seq, d.confidence
FROM final JOIN detections d ON d.frame_id = final.frame_id AND d.det_seq = final.det_seq""")
def nms_per_frame(spark, sf):
    d = materialize(detections(spark, sf).select("frame_id", "camera_id", "det_seq", "confidence", "x1", "y1", "x2", "y2"),
                    "boxes")
    return boxes.nms(d, ["frame_id"], iou_threshold=0.5).select("frame_id", "camera_id", "det_seq", "confidence")


_LINK_SQL = FD + f"""
, nxt AS (SELECT frame_id, lead(frame_id) OVER (PARTITION BY camera_id ORDER BY frame_id) AS next_frame_id
          FROM frames),
pairs AS (SELECT a.camera_id, a.frame_id, a.det_seq, b.frame_id AS next_frame_id, b.det_seq AS next_det_seq,
                 {iou_sql('a', 'b')} AS iou
          FROM detections a JOIN nxt n ON a.frame_id = n.frame_id
          JOIN detections b ON b.frame_id = n.next_frame_id
          WHERE {iou_sql('a', 'b')} >= 0.3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY frame_id, det_seq ORDER BY round(iou, 9) DESC, next_det_seq) AS ra,
                     row_number() OVER (PARTITION BY next_frame_id, next_det_seq ORDER BY round(iou, 9) DESC, det_seq) AS rb
           FROM pairs),
links AS (SELECT camera_id, frame_id, det_seq, next_frame_id, next_det_seq, iou FROM ranked WHERE ra = 1 AND rb = 1)
"""


def _links(spark, sf):
    # read for both sides, the counts and the tracks: compute once
    d = materialize(detections(spark, sf).select("camera_id", "frame_id", "det_seq", "x1", "y1", "x2", "y2"), "boxes")
    f = frames(spark, sf).select("camera_id", "frame_id")
    nxt = with_neighbor(f, ["camera_id"], ["frame_id"], F.floor(F.col("frame_id") / 4096),
                        ["frame_id"], "next")
    a = d.join(nxt.select("frame_id", "next_frame_id"), "frame_id")
    # by the frame alone, so that the ranks of the next frame's boxes need no further shuffle
    pairs = boxes.overlap_pairs(a, d, ["next_frame_id"], ["frame_id"], ["camera_id", "frame_id", "det_seq"],
                                ["camera_id", "det_seq"], a_prefix="a_", b_prefix="b_",
                                extra=F.col("a_camera_id") == F.col("b_camera_id"))
    pairs = (pairs.where(F.col("iou") >= 0.3)
             .select(F.col("a_camera_id").alias("camera_id"), F.col("a_frame_id").alias("frame_id"),
                     F.col("a_det_seq").alias("det_seq"), F.col("a_next_frame_id").alias("next_frame_id"),
                     F.col("b_det_seq").alias("next_det_seq"), "iou",
                     F.round("iou", 9).alias("iou9")))
    best = boxes.mutual_best(pairs, ["frame_id", "det_seq"], ["next_frame_id", "next_det_seq"],
                             "iou9", tie_a="det_seq", tie_b="next_det_seq")
    return d, best.drop("iou9")


@query("iou_link_next_frame", _LINK_SQL + """
SELECT camera_id, frame_id, det_seq, next_frame_id, next_det_seq, round(iou, 6) AS iou FROM links""")
def iou_link_next_frame(spark, sf):
    _, links = _links(spark, sf)
    return links.withColumn("iou", F.round("iou", 6))


@query("local_tracks", "WITH RECURSIVE " + _LINK_SQL[len("WITH "):] + """
, heads AS (SELECT d.camera_id, d.frame_id, d.det_seq FROM detections d
            WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.next_frame_id = d.frame_id
                                                      AND l.next_det_seq = d.det_seq)),
walk(camera_id, frame_id, det_seq, track_frame_id, track_det_seq) AS (
  SELECT camera_id, frame_id, det_seq, frame_id, det_seq FROM heads
  UNION ALL
  SELECT w.camera_id, l.next_frame_id, l.next_det_seq, w.track_frame_id, w.track_det_seq
  FROM walk w JOIN links l ON l.frame_id = w.frame_id AND l.det_seq = w.det_seq)
SELECT camera_id, frame_id, det_seq, track_frame_id, track_det_seq FROM walk""")
def local_tracks(spark, sf):
    """V7: chain mutual-best links into tracks; a track is named by its
    first detection (the component's least (frame_id, det_seq))."""
    d, links = _links(spark, sf)
    e = links.select(F.struct("frame_id", "det_seq").alias("src"),
                     F.struct(F.col("next_frame_id").alias("frame_id"),
                              F.col("next_det_seq").alias("det_seq")).alias("dst"))
    heads = chain_heads(e, out="track")
    v = d.select(F.struct("frame_id", "det_seq").alias("dst"), "camera_id")
    t = v.join(heads, "dst", "left").withColumn("track", F.coalesce("track", "dst"))
    return t.select("camera_id", F.col("dst.frame_id").alias("frame_id"), F.col("dst.det_seq").alias("det_seq"),
                    F.col("track.frame_id").alias("track_frame_id"), F.col("track.det_seq").alias("track_det_seq"))


# Fixed parameter (our choice): a track may be lost for two frames.
GRACE = 3


def _gap_sql(grace: int) -> str:
    """The links gap by gap, as ``gap_links`` takes them."""
    out = FD + """
, numbered AS (SELECT frame_id, CAST(row_number() OVER (PARTITION BY camera_id ORDER BY ts, frame_id) AS BIGINT) AS frame_no
               FROM frames),
b AS (SELECT d.camera_id, n.frame_no, d.det_seq, d.x1, d.y1, d.x2, d.y2 FROM detections d JOIN numbered n USING (frame_id)),
l0 AS (SELECT camera_id, frame_no, det_seq, frame_no AS next_frame_no, det_seq AS next_det_seq, 0.0 AS iou, 0 AS gap
       FROM b WHERE false)"""
    for g in range(1, grace + 1):
        out += f"""
, p{g} AS (SELECT a.camera_id, a.frame_no, a.det_seq, z.frame_no AS next_frame_no, z.det_seq AS next_det_seq,
             {iou_sql('a', 'z')} AS iou
           FROM b a JOIN b z ON a.camera_id = z.camera_id AND z.frame_no = a.frame_no + {g}
           WHERE {iou_sql('a', 'z')} >= 0.3
             AND NOT EXISTS (SELECT 1 FROM l{g - 1} l WHERE l.camera_id = a.camera_id AND l.frame_no = a.frame_no
                             AND l.det_seq = a.det_seq)
             AND NOT EXISTS (SELECT 1 FROM l{g - 1} l WHERE l.camera_id = z.camera_id AND l.next_frame_no = z.frame_no
                             AND l.next_det_seq = z.det_seq))
, r{g} AS (SELECT *, row_number() OVER (PARTITION BY camera_id, frame_no, det_seq ORDER BY round(iou, 9) DESC, next_det_seq) AS ra,
             row_number() OVER (PARTITION BY camera_id, next_frame_no, next_det_seq ORDER BY round(iou, 9) DESC, det_seq) AS rb
           FROM p{g})
, l{g} AS (SELECT * FROM l{g - 1} UNION ALL
           SELECT camera_id, frame_no, det_seq, next_frame_no, next_det_seq, iou, {g} FROM r{g} WHERE ra = 1 AND rb = 1)"""
    return out


def numbered_boxes(spark, sf):
    """Boxes with the running number of their frame in its camera."""
    f = frames(spark, sf).select("frame_id", "camera_id", "ts")
    no = running_total(f, ["camera_id"], ["ts", "frame_id"], F.date_trunc("day", "ts"), None, "frame_no")
    d = detections(spark, sf).select("frame_id", "det_seq", "x1", "y1", "x2", "y2")
    return d.join(no.select("frame_id", "camera_id", "frame_no"), "frame_id").drop("frame_id")


@query("tracks_with_grace", "WITH RECURSIVE " + _gap_sql(GRACE)[len("WITH "):] + f"""
, heads AS (SELECT camera_id, frame_no, det_seq FROM b
            WHERE NOT EXISTS (SELECT 1 FROM l{GRACE} l WHERE l.camera_id = b.camera_id AND l.next_frame_no = b.frame_no
                              AND l.next_det_seq = b.det_seq)),
walk(camera_id, frame_no, det_seq, track_frame_no, track_det_seq, gap) AS (
  SELECT camera_id, frame_no, det_seq, frame_no, det_seq, 0 FROM heads
  UNION ALL
  SELECT w.camera_id, l.next_frame_no, l.next_det_seq, w.track_frame_no, w.track_det_seq, l.gap
  FROM walk w JOIN l{GRACE} l ON l.camera_id = w.camera_id AND l.frame_no = w.frame_no AND l.det_seq = w.det_seq)
SELECT * FROM walk""")
def tracks_with_grace(spark, sf):
    """V7 with a grace: tracks that survive two lost frames. ``gap`` is the
    number of frames since the track was last seen, 0 at its start."""
    b = materialize(numbered_boxes(spark, sf), "numbered-boxes")
    links = boxes.gap_links(b, grace=GRACE)
    e = links.select(F.struct("camera_id", "frame_no", "det_seq").alias("src"),
                     F.struct(F.col("camera_id"), F.col("next_frame_no").alias("frame_no"),
                              F.col("next_det_seq").alias("det_seq")).alias("dst"), "gap")
    heads = chain_heads(e, out="track").join(e.select("dst", "gap"), "dst")
    t = b.select(F.struct("camera_id", "frame_no", "det_seq").alias("dst")).join(heads, "dst", "left")
    t = t.withColumn("track", F.coalesce("track", "dst"))
    return t.select("dst.camera_id", "dst.frame_no", "dst.det_seq", F.col("track.frame_no").alias("track_frame_no"),
                    F.col("track.det_seq").alias("track_det_seq"), F.coalesce("gap", F.lit(0)).alias("gap"))


# Fixed value: the least IoU of a prediction with its truth.
MATCH_IOU = 0.3

_MATCH_SQL = "WITH RECURSIVE " + FD[len("WITH "):] + f"""
, truth AS (SELECT * FROM detections WHERE det_seq % 2 = 0),
pred AS (SELECT * FROM detections WHERE det_seq % 2 = 1),
pairs AS (SELECT t.camera_id, t.frame_id, t.det_seq AS truth_seq, p.det_seq AS pred_seq, p.confidence,
                 round({iou_sql('t', 'p')}, 9) AS iou
          FROM truth t JOIN pred p ON t.frame_id = p.frame_id WHERE {iou_sql('t', 'p')} >= {MATCH_IOU}),
ordered AS (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY confidence DESC, iou DESC, truth_seq, pred_seq) AS rk
            FROM pairs),
walk(frame_id, rk, truths, preds) AS (
  SELECT frame_id, rk, [truth_seq], [pred_seq] FROM ordered WHERE rk = 1
  UNION ALL
  SELECT o.frame_id, o.rk,
         CASE WHEN list_contains(w.truths, o.truth_seq) OR list_contains(w.preds, o.pred_seq) THEN w.truths
              ELSE list_append(w.truths, o.truth_seq) END,
         CASE WHEN list_contains(w.truths, o.truth_seq) OR list_contains(w.preds, o.pred_seq) THEN w.preds
              ELSE list_append(w.preds, o.pred_seq) END
  FROM walk w JOIN ordered o ON o.frame_id = w.frame_id AND o.rk = w.rk + 1),
last AS (SELECT frame_id, unnest(truths) AS truth_seq, unnest(preds) AS pred_seq
         FROM walk QUALIFY row_number() OVER (PARTITION BY frame_id ORDER BY rk DESC) = 1),
matched AS (SELECT p.* FROM last JOIN pairs p USING (frame_id, truth_seq, pred_seq))
"""


def _matches(spark, sf):
    # read for the pairs and for the counts of the curve: compute once
    d = materialize(detections(spark, sf).select("camera_id", "frame_id", "det_seq", "confidence", "x1", "y1", "x2", "y2"),
                    "boxes")
    is_truth = F.pmod("det_seq", F.lit(2)) == 0
    truth, pred = d.where(is_truth), d.where(~is_truth)
    keys = ["camera_id", "frame_id"]
    pairs = boxes.overlap_pairs(truth, pred, keys, keys, ["det_seq"], ["det_seq", "confidence"], a_prefix="t_", b_prefix="p_")
    pairs = pairs.where(F.col("iou") >= MATCH_IOU).select(
        F.col("t_camera_id").alias("camera_id"), F.col("t_frame_id").alias("frame_id"),
        F.col("t_det_seq").alias("truth_seq"), F.col("p_det_seq").alias("pred_seq"),
        F.col("p_confidence").alias("confidence"), F.round("iou", 9).alias("iou"))
    hits = assignment.greedy_matching(pairs, keys, ["truth_seq"], ["pred_seq"], [("confidence", False), ("iou", False)])
    return truth, pred, hits


@query("detection_matches", _MATCH_SQL + """
SELECT camera_id, frame_id, truth_seq, pred_seq, confidence, round(iou, 6) AS iou FROM matched""")
def detection_matches(spark, sf):
    """One-to-one matches. Predictions in the order of their confidence
    take the free truth of greatest IoU; a second choice counts."""
    return _matches(spark, sf)[2].withColumn("iou", F.round("iou", 6)).select(
        "camera_id", "frame_id", "truth_seq", "pred_seq", "confidence", "iou")


_CURVE_SQL = _MATCH_SQL + """
, scored AS (SELECT camera_id, confidence AS threshold, count(*) AS p FROM pred GROUP BY ALL),
hit AS (SELECT camera_id, confidence AS threshold, count(*) AS h FROM matched GROUP BY ALL),
n AS (SELECT camera_id, count(*) AS n_truth FROM truth GROUP BY camera_id),
curve AS (SELECT camera_id, threshold, n_truth, CAST(sum(p) OVER w AS BIGINT) AS n_pred,
                 CAST(sum(coalesce(h, 0)) OVER w AS BIGINT) AS tp
          FROM scored LEFT JOIN hit USING (camera_id, threshold) LEFT JOIN n USING (camera_id)
          WINDOW w AS (PARTITION BY camera_id ORDER BY threshold DESC))
"""


@query("precision_recall_curve", _CURVE_SQL + """
SELECT camera_id, threshold, n_pred, tp, n_truth, round(tp / n_pred, 6) AS precision, round(tp / n_truth, 6) AS recall FROM curve""")
def precision_recall_curve(spark, sf):
    """Precision and recall of each camera over thresholds of confidence."""
    truth, pred, hits = _matches(spark, sf)
    c = assignment.precision_recall_curve(pred, truth, hits, "camera_id", "confidence")
    return c.withColumn("precision", F.round("precision", 6)).withColumn("recall", F.round("recall", 6))


@query("average_precision", _CURVE_SQL + """
, best AS (SELECT camera_id, tp / n_truth - coalesce(lag(tp / n_truth) OVER (PARTITION BY camera_id ORDER BY threshold DESC), 0) AS step,
                  max(tp / n_pred) OVER (PARTITION BY camera_id ORDER BY threshold) AS precision FROM curve)
SELECT camera_id, round(sum(step * precision), 6) AS ap FROM best GROUP BY camera_id""")
def average_precision(spark, sf):
    """Area under each camera's curve."""
    truth, pred, hits = _matches(spark, sf)
    c = assignment.precision_recall_curve(pred, truth, hits, "camera_id", "confidence")
    return assignment.average_precision(c, "camera_id").withColumn("ap", F.round("ap", 6))


@query("detection_precision_recall", FD + f"""
, truth AS (SELECT * FROM detections WHERE det_seq % 2 = 0),
pred AS (SELECT * FROM detections WHERE det_seq % 2 = 1),
pairs AS (SELECT t.camera_id, t.frame_id, t.det_seq AS truth_seq, p.det_seq AS pred_seq,
                 round({iou_sql('t', 'p')}, 9) AS iou
          FROM truth t JOIN pred p ON t.frame_id = p.frame_id WHERE {iou_sql('t', 'p')} >= 0.3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY frame_id, truth_seq ORDER BY iou DESC, pred_seq) AS ra,
                     row_number() OVER (PARTITION BY frame_id, pred_seq ORDER BY iou DESC, truth_seq) AS rb
           FROM pairs),
tp AS (SELECT camera_id, count(*) AS tp FROM ranked WHERE ra = 1 AND rb = 1 GROUP BY camera_id),
cnt AS (SELECT camera_id, count(*) FILTER (WHERE det_seq % 2 = 0) AS n_truth,
               count(*) FILTER (WHERE det_seq % 2 = 1) AS n_pred FROM detections GROUP BY camera_id)
SELECT c.camera_id, CAST(c.n_truth AS BIGINT) AS n_truth, CAST(c.n_pred AS BIGINT) AS n_pred,
       CAST(coalesce(tp.tp, 0) AS BIGINT) AS tp,
       round(CASE WHEN c.n_pred > 0 THEN coalesce(tp.tp, 0) / c.n_pred END, 6) AS precision,
       round(CASE WHEN c.n_truth > 0 THEN coalesce(tp.tp, 0) / c.n_truth END, 6) AS recall
FROM cnt c LEFT JOIN tp ON c.camera_id = tp.camera_id""")
def detection_precision_recall(spark, sf):
    """Match predictions to ground truth per frame (mutual best IoU
    >= 0.3); precision and recall per camera. In the fixture, even
    ``det_seq`` rows play the truth and odd rows the predictions."""
    d = materialize(detections(spark, sf).select("camera_id", "frame_id", "det_seq", "x1", "y1", "x2", "y2"), "boxes")
    is_truth = F.pmod("det_seq", F.lit(2)) == 0
    truth, pred = d.where(is_truth), d.where(~is_truth)
    pairs = boxes.overlap_pairs(truth, pred, ["camera_id", "frame_id"], ["camera_id", "frame_id"],
                                ["det_seq"], ["det_seq"], a_prefix="t_", b_prefix="p_")
    pairs = pairs.where(F.col("iou") >= 0.3).select(
        F.col("t_camera_id").alias("camera_id"), F.col("t_frame_id").alias("frame_id"),
        F.col("t_det_seq").alias("truth_seq"), F.col("p_det_seq").alias("pred_seq"),
        F.round("iou", 9).alias("iou"))
    matched = boxes.mutual_best(pairs, ["frame_id", "truth_seq"], ["frame_id", "pred_seq"], "iou",
                                tie_a="truth_seq", tie_b="pred_seq")
    tp = matched.groupBy("camera_id").agg(F.count(F.lit(1)).alias("tp"))
    cnt = d.groupBy("camera_id").agg(F.count(F.when(is_truth, 1)).alias("n_truth"),
                                     F.count(F.when(~is_truth, 1)).alias("n_pred"))
    j = cnt.join(tp, "camera_id", "left").withColumn("tp", F.coalesce("tp", F.lit(0)).cast("long"))
    return j.select("camera_id", "n_truth", "n_pred", "tp",
                    F.round(F.try_divide(F.col("tp"), F.col("n_pred")), 6).alias("precision"),
                    F.round(F.try_divide(F.col("tp"), F.col("n_truth")), 6).alias("recall"))
