import json

import pytest
from pyspark.sql import functions as F

from sightline.operators.filters import DetectionPolicy
from sightline.operators.messages import to_json_value
from sightline.operators.scoring import detections_struct, score_frames
from sightline.operators.messages import scored_messages
from sightline.operators.shapes import boxes_on_frame, jpeg_shape, with_frame_shape
from sightline.sources import envelopes, files


def jpeg(h, w, c=3, before=b"", marker=0xC0):
    size = (8 + 3 * c).to_bytes(2, "big")
    return b"\xff\xd8" + before + bytes([0xFF, marker]) + size + b"\x08" + h.to_bytes(2, "big") + w.to_bytes(2, "big") \
        + bytes([c]) + b"\0" * (3 * c) + b"\xff\xda\0\x02"


APP = b"\xff\xe1\xff\xff" + b"\xff\xc0" * 32766 + b"\0"               # a segment that holds what looks like headers


@pytest.mark.parametrize("payload,shape", [
    (jpeg(480, 640), (480, 640, 3)), (jpeg(1, 65535, 1, marker=0xC2), (1, 65535, 1)), (jpeg(7, 9, before=APP), (7, 9, 3)),
    (jpeg(7, 9, before=b"\xff\xff\xff\xc4\0\x02\xff\x01"), (7, 9, 3)), (None, None), (b"", None), (b"\xff\xd8", None),
    (b"\xff\xd8xxx", None), (jpeg(480, 640)[:8], None), (jpeg(0, 640), None), (b"\xff\xd8\xff\xe0\0\x01", None),
    (b"\xff\xd8\xff\xda\0\x02" + jpeg(4, 4)[2:], None), (b"\xff\xd8\xff\xe0\0\x09ab", None), (b"\x89PNG", None)])
def test_markers(payload, shape):
    assert jpeg_shape(payload) == shape


def test_shape_in_messages_and_boxes_back_on_the_frame(spark):
    rows = [("cam1", "f1", jpeg(960, 1280)), ("cam1", "f2", b"\xff\xd8xx"), ("cam1", "f3", None)]
    f = spark.createDataFrame(rows, "camera_id string, frame_id string, payload binary").withColumn("ts", F.current_timestamp())
    scored = score_frames(f, policy=DetectionPolicy(0.5))
    msgs = scored_messages(detections_struct(scored), DetectionPolicy(0.5), "m", {0: "person"})
    sent = {r.key: json.loads(r.value) for r in to_json_value(msgs).collect()}
    assert sent["f1"]["frame_shape"] == [960, 1280, 3] and "frame_shape" not in sent["f2"]
    shaped = {r.frame_id: r.frame_shape for r in with_frame_shape(f).collect()}
    assert shaped == {"f1": [960, 1280, 3], "f2": None, "f3": None}
    boxes = spark.createDataFrame([("a", 10.0, 20.0, 30.0, 40.0, [960, 1280, 3]), ("b", 10.0, 20.0, 30.0, 40.0, [100, 200, 3]),
                                   ("c", 1.0, 1.0, 2.0, 2.0, None)],
                                  "k string, x1 double, y1 double, x2 double, y2 double, frame_shape array<int>")
    got = {r.k: (r.x1, r.y1, r.x2, r.y2) for r in boxes_on_frame(boxes).collect()}
    assert got == {"a": (20.0, 40.0, 60.0, 80.0), "b": (10.0, 20.0, 30.0, 40.0), "c": (None,) * 4}


def test_files_without_a_number_do_not_stop_the_scan(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/C1")
    for name in ("00000001.jpg", "thumb.jpg", "99999999999999999999.jpg"):
        with open(f"{tmp_dir}/C1/{name}", "wb") as f:
            f.write(jpeg(2, 2))
    with open(f"{tmp_dir}/00000002.jpg", "wb") as f:
        f.write(jpeg(2, 2))
    got = {r.path.rsplit("/", 1)[1]: (r.camera_id, r.frame_id, r.error) for r in files.read_frames_dir(spark, tmp_dir).collect()}
    none = "no frame number in the file name"
    assert got == {"00000001.jpg": ("cam1", 1, None), "thumb.jpg": ("cam1", None, none),
                   "99999999999999999999.jpg": ("cam1", None, none), "00000002.jpg": (None, 2, "no camera in the path")}


@pytest.mark.parametrize("key", ["plain", "a$1", "$0", 'quote"d', "back\\slash", "\\$1", "tab\tnew\nline", "ünï", "", "{}"])
def test_any_key_goes_into_the_text(spark, key):
    df = spark.createDataFrame([('{"frame_id":  "", "n": 1}', key)], "t string, k string")
    out = df.select(envelopes.patch_json_id(F.col("t"), "frame_id", F.col("k")).alias("o")).first().o
    assert json.loads(out) == {"frame_id": key, "n": 1}
    none = df.select(envelopes.patch_json_id(F.col("t"), "frame_id", F.lit(None)).alias("o")).first().o
    assert none == '{"frame_id":  "", "n": 1}'


def test_class_names_follow_the_id(spark):
    dets = [{"class": 2}, {"class_id": 0}, {"class": "dog"}, {"class_id": 2, "class_name": "x"}, {"class": 77}, {}]
    text = json.dumps({"frame_id": "f", "detections": [{"bbox": [0, 0, 1, 1], "confidence": 0.5, **d} for d in dets]})
    df = spark.createDataFrame([(text,)], "value string")
    got = envelopes.parse_detection_messages(df).first().detections
    assert [d["class_name"] for d in got] == ["bicycle", "person", "dog", "x", "class_77", "person"]
