"""Detection messages (P5, P6, K6, K7): build, serialise, publish shape.

A message is one frame with its detections. Boxes are reduced per frame
(``collect_list`` of the frame's rows, sorted by ``det_seq``) before the
join with the frame table, so frames without boxes get ``[]`` and the
frame table itself is never regrouped. The JSON text is produced by
``to_json(struct(...))``: ids are written as fields, never patched into
text afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.filters import DetectionPolicy
from sightline.sources.envelopes import encode_base64


#: Wire form of a message's time.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def message_columns(detections: Column, policy: DetectionPolicy, model: str, ts: str = "ts",
                    shape: Column | None = None) -> list[Column]:
    """The fields that every published detection message has; the batch
    builders and the streaming job share them, and
    ``parse_detection_messages`` reads them back. ``shape`` is the frame's
    [height, width, channels], where it is known."""
    return [
        F.col("camera_id"),
        F.col("frame_id").cast("string").alias("frame_id"),
        F.date_format(ts, ISO_MICROS).alias("timestamp"),
        detections.alias("detections"),
        F.size(detections).alias("detection_count"),
        F.lit(model).alias("model"),
        F.lit(float(policy.threshold)).alias("confidence_threshold"),
        *([shape.alias("frame_shape")] if shape is not None else []),
    ]


def class_name_of(class_id: Column, names: dict[int, str]) -> Column:
    """The label of a class id; ``class_<id>`` if it has none."""
    known = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair])
    return F.coalesce(F.try_element_at(known, class_id), F.concat(F.lit("class_"), class_id.cast("string")))


def scored_messages(scored: DataFrame, policy: DetectionPolicy, model: str, names: dict[int, str]) -> DataFrame:
    """Messages of scored frames (``scoring.detections_struct``): the shared
    fields, with what the scorer adds: frame shape, node, time and error."""
    dets = F.transform("detections", lambda d: d.withField("class_name", class_name_of(d["class_id"], names)))
    return scored.select(*message_columns(dets, policy, model, shape=F.col("frame_shape")), "processing_node", "processing_time_ms", "error")


def detection_struct(class_names: Column | None = None) -> Column:
    return F.struct(
        F.col("det_seq").alias("det_seq"),
        F.array("x1", "y1", "x2", "y2").alias("bbox"),
        F.col("confidence").alias("confidence"),
        F.col("class_id").alias("class_id"),
        (class_names if class_names is not None else F.lit(None).cast("string")).alias("class_name"),
    )


def build_messages(frames: DataFrame, dets: DataFrame, policy: DetectionPolicy,
                   model: str, keys=("frame_id", "camera_id"),
                   class_names: Column | None = None) -> DataFrame:
    """One message row per frame, empty frames included."""
    kept = dets.where(policy.predicate())
    per_frame = kept.groupBy(*keys).agg(
        F.sort_array(F.collect_list(detection_struct(class_names))).alias("detections"))
    msgs = frames.join(per_frame, list(keys), "left")
    dets_col = F.coalesce(F.col("detections"), F.array().cast(per_frame.schema["detections"].dataType))
    return msgs.select(*message_columns(F.transform(dets_col, lambda d: d.dropFields("det_seq")), policy, model))


def build_message_parts(frames: DataFrame, dets: DataFrame, policy: DetectionPolicy,
                        model: str, max_boxes: int, keys=("frame_id", "camera_id"),
                        class_names: Column | None = None) -> DataFrame:
    """P6 with a bounded message size: a frame's boxes are split into parts
    of at most ``max_boxes`` (by ``det_seq``), so even a frame holding a
    third of all boxes is assembled by many tasks. Every box is in exactly
    one part; ``part_no``/``n_parts`` let a consumer reassemble the frame.
    Frames without boxes get one empty part.
    """
    kept = dets.where(policy.predicate()).withColumn(
        "part_no", F.floor(F.col("det_seq") / F.lit(max_boxes)).cast("long"))
    parts = kept.groupBy(*keys, "part_no").agg(
        F.sort_array(F.collect_list(detection_struct(class_names))).alias("detections"))
    n_parts = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_parts"))
    msgs = (frames.join(parts, list(keys), "left").join(n_parts, list(keys), "left"))
    dets_col = F.coalesce(F.col("detections"), F.array().cast(parts.schema["detections"].dataType))
    fields = message_columns(F.transform(dets_col, lambda d: d.dropFields("det_seq")), policy, model)
    return msgs.select(*fields[:2], F.coalesce(F.col("part_no"), F.lit(0)).alias("part_no"),
                       F.coalesce(F.col("n_parts"), F.lit(1)).alias("n_parts"), *fields[2:])


def to_json_value(messages: DataFrame, key_col: str = "frame_id") -> DataFrame:
    """K6: (key, value) pairs for a Kafka sink; value is UTF-8 JSON."""
    fields = [c for c in messages.columns]
    return messages.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in fields])).alias("value"),
    )


def envelope_value(frame_id: Column, ts: Column, payload: Column) -> Column:
    """K7: JSON envelope with a base64 payload."""
    return F.to_json(F.struct(
        frame_id.cast("string").alias("frame_id"),
        F.date_format(ts, ISO_MICROS).alias("timestamp"),
        encode_base64(payload).alias("data"),
    ))
