"""Golden messages and record decoding (defects D1, D2, D5, D11; FIXTURES §2)."""

import base64
import json

from pyspark.sql import functions as F

from sightline.operators.filters import DetectionPolicy, filter_nested, nonempty
from sightline.operators.messages import build_messages, envelope_value, to_json_value
from sightline.sources.envelopes import parse_detection_messages, patch_json_id, sniff_frames

# The one sample message of the reference docs (values only).
SAMPLE = {
    "camera_id": "cam1", "frame_id": "offset_123", "timestamp": "2025-01-15T10:30:45.123456",
    "detections": [{"bbox": [272.23, 133.27, 336.24, 295.82], "confidence": 0.89,
                    "class_id": 0, "class_name": "person"}],
    "detection_count": 1, "model": "nano-detector", "confidence_threshold": 0.5,
    "processing_node": "spark-worker-12345", "processing_time_ms": 156.7,
}

RECORD = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"


def _records(spark, rows):
    return spark.createDataFrame(rows, RECORD)


def test_sample_message_parses_and_reemits(spark):
    df = spark.createDataFrame([(json.dumps(SAMPLE),)], "value string")
    m = parse_detection_messages(df).collect()[0]
    assert m.frame_id == "offset_123" and m.camera_id == "cam1"
    assert m.detection_count == 1 and m.processing_time_ms == 156.7
    d = m.detections[0]
    assert d.bbox == [272.23, 133.27, 336.24, 295.82] and d.confidence == 0.89
    assert d.class_id == 0 and d.class_name == "person"
    assert str(m.ts) == "2025-01-15 10:30:45.123456"


def test_error_message_keeps_error_and_zero_detections(spark):
    msg = {"camera_id": "cam1", "frame_id": "7", "detections": [], "detection_count": 0,
           "error": "decode failed"}
    m = parse_detection_messages(spark.createDataFrame([(json.dumps(msg),)], "value string")).collect()[0]
    assert m.error == "decode failed" and m.detection_count == 0 and m.detections == []


def test_missing_fields_get_defaults(spark):
    msgs = [json.dumps({"camera_id": "cam2", "frame_id": "1"}),
            json.dumps({"camera_id": "cam2", "frame_id": "2",
                        "detections": [{"bbox": [0, 0, 1, 1], "confidence": 0.7, "class_id": 0}]})]
    rows = parse_detection_messages(spark.createDataFrame([(m,) for m in msgs], "value string")) \
        .orderBy("frame_id").collect()
    assert rows[0].detections == [] and rows[0].detection_count == 0
    assert rows[1].detections[0].class_name == "person"


def test_variants_b_and_c_normalise(spark):
    b = {"frame_id": "1", "detections": [{"class": "person", "confidence": 0.87, "bbox": [1.5, 2.5, 3.5, 4.5]}]}
    c = {"frame_id": "2", "detections": [{"class": 0, "confidence": 0.5, "bbox": [1, 2, 3, 4]}]}
    rows = parse_detection_messages(spark.createDataFrame([(json.dumps(b),), (json.dumps(c),)],
                                                          "value string")).orderBy("frame_id").collect()
    assert rows[0].detections[0].class_name == "person" and rows[0].detections[0].class_id is None
    assert rows[1].detections[0].class_id == 0


def test_bad_json_is_not_a_null_row(spark):
    m = parse_detection_messages(spark.createDataFrame([("{not json",)], "value string")).collect()[0]
    assert m.detections == [] and m.detection_count == 0


def test_frame_id_patch_tolerates_spacing(spark):
    df = spark.createDataFrame([('{"frame_id": "", "k": 1}',), ('{"frame_id":"", "k": 2}',)], "t string")
    out = [r[0] for r in df.select(patch_json_id(F.col("t"), "frame_id", F.lit("cam1-0-5"))).collect()]
    assert all('"frame_id": "cam1-0-5"' in o for o in out)


def test_sniff_routes_jpeg_envelope_and_junk(spark):
    jpeg = b"\xff\xd8\xff\xe0rest"
    env_ok = json.dumps({"frame_id": "0", "timestamp": "2025-01-01T00:00:00",
                         "data": base64.b64encode(jpeg).decode()}).encode()
    env_bad = json.dumps({"frame_id": "1", "timestamp": "2025-01-01T00:00:01", "data": "!!!"}).encode()
    rows = [(None, jpeg, "cam3-frames", 0, 10, None),
            (None, env_ok, "cam3-frames", 1, 10, None),
            (None, env_bad, "cam3-frames", 1, 11, None),
            (None, b"\x89PNG....", "cam3-frames", 2, 12, None),
            (None, base64.b64encode(jpeg), "cam3-frames", 3, 13, None),
            (None, base64.b64encode(b"no image"), "cam3-frames", 3, 14, None)]
    out = sniff_frames(_records(spark, rows)).orderBy("frame_key").collect()
    by_key = {r.frame_key: r for r in out}
    # NULL key => topic-partition-offset id, never a NULL row
    assert set(by_key) == {"cam3-frames-0-10", "cam3-frames-1-10", "cam3-frames-1-11", "cam3-frames-2-12",
                           "cam3-frames-3-13", "cam3-frames-3-14"}
    # bare base64 text of a JPEG is a frame, other base64 text is not
    assert by_key["cam3-frames-3-13"].error is None and bytes(by_key["cam3-frames-3-13"].payload) == jpeg
    assert by_key["cam3-frames-3-14"].error == "not a frame envelope"
    assert by_key["cam3-frames-0-10"].error is None and bytes(by_key["cam3-frames-0-10"].payload) == jpeg
    assert by_key["cam3-frames-1-10"].error is None and bytes(by_key["cam3-frames-1-10"].payload) == jpeg
    assert by_key["cam3-frames-1-11"].error == "payload is not base64"
    assert by_key["cam3-frames-2-12"].error == "not a frame envelope"
    assert all(r.camera_id == "cam3" for r in out)        # from the topic (D8)


def test_envelope_roundtrip_is_one_line(spark):
    df = spark.createDataFrame([(1, bytes(range(256)) * 3)], "id long, payload binary") \
        .withColumn("ts", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    v = df.select(envelope_value(F.col("id"), F.col("ts"), F.col("payload")).alias("v")).collect()[0].v
    env = json.loads(v)
    assert "\n" not in env["data"] and base64.b64decode(env["data"]) == bytes(range(256)) * 3


def test_built_messages_include_empty_frames_and_threshold_inclusive(spark):
    frames = spark.createDataFrame([(1, "cam1", "2025-01-01 00:00:00"), (2, "cam1", "2025-01-01 00:00:01")],
                                   "frame_id long, camera_id string, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    dets = spark.createDataFrame([(1, "cam1", 0, 0.0, 0.0, 1.0, 1.0, 0.5, 0),
                                  (1, "cam1", 1, 0.0, 0.0, 1.0, 1.0, 0.49, 0)],
                                 "frame_id long, camera_id string, det_seq long, x1 double, y1 double, "
                                 "x2 double, y2 double, confidence double, class_id int")
    msgs = build_messages(frames, dets, DetectionPolicy(0.5), "m").orderBy("frame_id").collect()
    assert [m.detection_count for m in msgs] == [1, 0]
    kv = to_json_value(build_messages(frames, dets, DetectionPolicy(0.5), "m")).collect()
    assert all(json.loads(r.value)["frame_id"] == r.key for r in kv)      # D1: id filled


def test_nested_filter_and_nonempty(spark):
    df = parse_detection_messages(spark.createDataFrame([(json.dumps(SAMPLE),)], "value string"))
    assert nonempty(filter_nested(df, DetectionPolicy(0.9))).count() == 0
    assert nonempty(filter_nested(df, DetectionPolicy(0.5, (0,)))).count() == 1


def test_message_parts_bound_the_size_and_keep_every_box(spark):
    from sightline.operators.messages import build_message_parts
    frames = spark.createDataFrame([(1, "cam1", "2025-01-01 00:00:00"), (2, "cam1", "2025-01-01 00:00:01")],
                                   "frame_id long, camera_id string, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    dets = spark.createDataFrame([(1, "cam1", s, 0.0, 0.0, 1.0, 1.0, 0.9, 0) for s in range(5)],
                                 "frame_id long, camera_id string, det_seq long, x1 double, y1 double, "
                                 "x2 double, y2 double, confidence double, class_id int")
    parts = build_message_parts(frames, dets, DetectionPolicy(0.5), "m", max_boxes=2) \
        .orderBy("frame_id", "part_no").collect()
    assert [(p.frame_id, p.part_no, p.n_parts, p.detection_count) for p in parts] == \
        [("1", 0, 3, 2), ("1", 1, 3, 2), ("1", 2, 3, 1), ("2", 0, 1, 0)]


def test_every_kind_of_result_is_published(spark):
    """One topic a kind; keys and all fields are in the messages."""
    from sightline.streaming.sinks import publish_results
    tracks = spark.createDataFrame([("cam1", 5, 2)], "camera_id string, frame_id long, local_id long")
    alerts = spark.createDataFrame([("cam1", 99)], "camera_id string, n long")
    sent = {}
    publish_results({"tracks": (tracks, ["camera_id", "frame_id"]), "alerts": (alerts, ["camera_id"])}, "b", "store",
                    publish=lambda kv, brokers, topic: sent.setdefault(topic, [tuple(r) for r in kv.collect()]))
    assert {t: [(k, json.loads(v)) for k, v in rows] for t, rows in sent.items()} == {
        "store-tracks": [("cam1|5", {"camera_id": "cam1", "frame_id": 5, "local_id": 2})],
        "store-alerts": [("cam1", {"camera_id": "cam1", "n": 99})]}
