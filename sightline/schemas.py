"""Schemas of the records sightline reads and writes.

Message schemas are supersets of every producer variant so one parse
serves them all; missing fields come back NULL and unknown ones are
ignored (``from_json`` is permissive).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Kafka source row (batch and streaming).
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# One box. Coordinates are pixels, corner form [x1, y1, x2, y2].
DETECTION = T.StructType([
    T.StructField("bbox", T.ArrayType(T.DoubleType())),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("class_id", T.IntegerType()),
    T.StructField("class_name", T.StringType()),
])

# Variants B / C use the key "class" for either the name or the id; it is
# read as text and normalised afterwards.
DETECTION_LOOSE = T.StructType(DETECTION.fields + [T.StructField("class", T.StringType())])

FRAME_SHAPE = T.StructType([
    T.StructField("h", T.IntegerType()),
    T.StructField("w", T.IntegerType()),
    T.StructField("c", T.IntegerType()),
])

# Superset of the producer and the Spark job messages; frame_id is text.
DETECTION_MESSAGE = T.StructType([
    T.StructField("camera_id", T.StringType()),
    T.StructField("frame_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("frame_shape", T.ArrayType(T.IntegerType())),
    T.StructField("detections", T.ArrayType(DETECTION_LOOSE)),
    T.StructField("detection_count", T.IntegerType()),
    T.StructField("model", T.StringType()),
    T.StructField("confidence_threshold", T.DoubleType()),
    T.StructField("processing_node", T.StringType()),
    T.StructField("processing_time_ms", T.DoubleType()),
    T.StructField("error", T.StringType()),
])

# JSON frame envelope: base64 payload and ISO timestamp as text.
FRAME_ENVELOPE = T.StructType([
    T.StructField("frame_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("data", T.StringType()),
])

# Canonical analytics tables (column order is the contract).
FRAMES = "camera_id string, frame_id long, ts timestamp_ntz, width int, height int"
DETECTIONS = ("camera_id string, frame_id long, ts timestamp_ntz, det_seq long, x1 double, "
              "y1 double, x2 double, y2 double, confidence double, class_id int")
SIGHTINGS = ("event_id long, global_id string, camera_id string, ts timestamp_ntz, "
             "confidence double, position_id int")
ERRORS = "camera_id string, frame_id string, stage string, error string, raw binary"
