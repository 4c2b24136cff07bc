"""Queries over records and messages: parse, emit, envelopes, errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.operators import filters
from sightline.operators.matching import CLASS_NAMES
from sightline.operators.messages import (build_message_parts, build_messages, class_name_of, envelope_value,
                                          to_json_value)
from sightline.plans.registry import query
from sightline.plans.sql_views import FD, with_views
from sightline.sources import envelopes, files
from sightline.sources.tables import detections, frames, kafka_records, table

# Kafka-shaped view of events for the oracle (mirrors tables.kafka_records).
KAFKA_SQL = with_views("""records AS (
  SELECT CASE WHEN event_type <> 'error' THEN 'P' || CAST(user_id AS VARCHAR) END AS key_text,
         props AS value_text,
         'cam' || CAST(user_id % 7 + 1 AS VARCHAR) || '-detections' AS topic,
         CAST(user_id % 4 AS INT) AS partition, event_id AS "offset", ts AS "timestamp",
         event_type, event_id, ts, props
  FROM events)""")


@query("frame_metadata_projection", KAFKA_SQL + """
SELECT coalesce(key_text, topic || '-' || CAST(partition AS VARCHAR) || '-' || CAST("offset" AS VARCHAR))
         AS frame_key,
       regexp_extract(topic, '^(cam\\d+)', 1) AS camera_id,
       "timestamp" AS kafka_timestamp, partition, "offset"
FROM records""")
def frame_metadata_projection(spark, sf):
    return envelopes.record_metadata(kafka_records(spark, sf))


@query("json_envelope_parse", """
SELECT CAST(event_id AS VARCHAR) AS frame_id, ts AS frame_ts, props AS payload_text FROM events""")
def json_envelope_parse(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "props")
    rec = ev.select(F.encode(envelope_value(F.col("event_id"), F.col("ts"),
                                            F.encode("props", "UTF-8")), "UTF-8").alias("value"))
    parsed = envelopes.parse_envelopes(rec)
    return parsed.select("frame_id", "frame_ts", F.decode("payload", "UTF-8").alias("payload_text"))


_NAMES_SQL = "CASE class_id WHEN 0 THEN 'person' WHEN 1 THEN 'bag' WHEN 2 THEN 'bicycle' END"


def _frames(spark, sf):
    return frames(spark, sf).select("frame_id", "camera_id", "ts")


@query("detection_message_parse", FD + f"""
, kept AS (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY det_seq) - 1 AS pos,
                  count(*) OVER (PARTITION BY frame_id) AS n FROM detections WHERE confidence >= 0.5)
SELECT CAST(f.frame_id AS VARCHAR) AS frame_id, f.camera_id, CAST(f.ts AS TIMESTAMP) AS ts,
       CAST(coalesce(k.n, 0) AS INTEGER) AS detection_count, CAST(k.pos AS INTEGER) AS pos,
       k.x1, k.y2, k.confidence, k.class_id, {_NAMES_SQL.replace('class_id', 'k.class_id')} AS class_name
FROM frames f LEFT JOIN kept k ON f.frame_id = k.frame_id""")
def detection_message_parse(spark, sf):
    """Messages of all frames, published as JSON and parsed again, one
    row per detection (frames without any keep one row)."""
    msgs = build_messages(_frames(spark, sf), detections(spark, sf), filters.DetectionPolicy(0.5), "stub-v1",
                          class_names=class_name_of(F.col("class_id"), CLASS_NAMES))
    back = envelopes.parse_detection_messages(to_json_value(msgs), "value")
    one = back.select("frame_id", "camera_id", "ts", "detection_count",
                      F.posexplode_outer("detections").alias("pos", "d"))
    return one.select("frame_id", "camera_id", "ts", "detection_count", "pos",
                      F.get(F.col("d.bbox"), 0).alias("x1"), F.get(F.col("d.bbox"), 3).alias("y2"),
                      F.col("d.confidence").alias("confidence"), F.col("d.class_id").alias("class_id"),
                      F.col("d.class_name").alias("class_name"))


@query("detection_message_parts", FD + """
, kept AS (SELECT *, CAST(floor(det_seq / 3) AS BIGINT) AS part_no FROM detections WHERE confidence >= 0.5),
parts AS (SELECT frame_id, part_no, CAST(count(*) AS INTEGER) AS n, arg_min(x2, det_seq) AS first_x2
          FROM kept GROUP BY frame_id, part_no),
n AS (SELECT frame_id, count(*) AS n_parts FROM parts GROUP BY frame_id)
SELECT CAST(f.frame_id AS VARCHAR) AS frame_id, f.camera_id, coalesce(p.part_no, 0) AS part_no,
       coalesce(n.n_parts, 1) AS n_parts, coalesce(p.n, 0) AS detection_count, p.first_x2
FROM frames f LEFT JOIN parts p ON f.frame_id = p.frame_id LEFT JOIN n ON f.frame_id = n.frame_id""")
def detection_message_parts(spark, sf):
    """P6 in messages of at most 3 boxes: no frame is gathered as a whole."""
    m = build_message_parts(_frames(spark, sf), detections(spark, sf), filters.DetectionPolicy(0.5), "stub-v1", 3)
    return m.select("frame_id", "camera_id", "part_no", "n_parts", "detection_count",
                    F.get(F.get(F.col("detections"), 0)["bbox"], 2).alias("first_x2"))


@query("detection_message_emit", FD + """
, kept AS (SELECT * FROM detections WHERE confidence >= 0.5)
SELECT CAST(f.frame_id AS VARCHAR) AS frame_id, f.camera_id,
       CAST(count(k.det_seq) AS INTEGER) AS detection_count,
       'stub-v1' AS model, CAST(0.5 AS DOUBLE) AS confidence_threshold,
       max(k.confidence) AS max_confidence,
       arg_min(k.class_id, k.det_seq) AS first_class_id,
       arg_min(k.x2, k.det_seq) AS first_x2
FROM frames f LEFT JOIN kept k ON f.frame_id = k.frame_id
GROUP BY f.frame_id, f.camera_id""")
def detection_message_emit(spark, sf):
    msgs = build_messages(frames(spark, sf).select("frame_id", "camera_id", "ts"),
                          detections(spark, sf), filters.DetectionPolicy(0.5), "stub-v1")
    kv = to_json_value(msgs)
    back = envelopes.parse_detection_messages(kv, "value")
    first = F.get(F.col("detections"), 0)
    return back.select(
        "frame_id", "camera_id", "detection_count", "model", "confidence_threshold",
        F.array_max(F.transform("detections", lambda d: d["confidence"])).alias("max_confidence"),
        first["class_id"].alias("first_class_id"),
        F.get(first["bbox"], 2).alias("first_x2"),
    )


@query("envelope_roundtrip", """
SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes,
       CAST(length(to_base64(encode(text))) AS BIGINT) AS b64_chars,
       decode(from_base64(to_base64(encode(text)))) = text AS roundtrip_ok
FROM documents""")
def envelope_roundtrip(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    raw = F.encode("text", "UTF-8")
    b64 = envelopes.encode_base64(raw)
    back = F.decode(envelopes.decode_base64(b64), "UTF-8")
    return d.select("doc_id", F.octet_length(raw).cast("long").alias("n_bytes"),
                    F.length(b64).cast("long").alias("b64_chars"),
                    (back == F.col("text")).alias("roundtrip_ok"))


@query("missing_field_defaults", FD + """
, kept AS (SELECT * FROM detections WHERE confidence >= 0.5)
SELECT CAST(f.frame_id AS VARCHAR) AS frame_id, CAST(count(k.det_seq) AS INTEGER) AS detection_count,
       CAST(count(k.det_seq) AS INTEGER) AS n_detections,
       CAST(count(k.det_seq) FILTER (WHERE f.frame_id % 6 = 1 OR k.class_id = 0) AS INTEGER) AS n_person
FROM frames f LEFT JOIN kept k ON f.frame_id = k.frame_id GROUP BY f.frame_id""")
def missing_field_defaults(spark, sf):
    """messages of all frames with fields left out: every third frame
    has no class names, every other of these no class ids either, every third
    no count, and frames without boxes no list."""
    frame = F.col("frame_id").cast("long")
    name = F.when(F.col("frame_id") % 3 != 1, class_name_of(F.col("class_id"), CLASS_NAMES))
    dets = detections(spark, sf).withColumn("class_id", F.when(F.col("frame_id") % 6 != 1, F.col("class_id")))
    msgs = build_messages(_frames(spark, sf), dets, filters.DetectionPolicy(0.5), "stub-v1", class_names=name)
    gaps = (msgs.withColumn("detections", F.when(F.size("detections") > 0, F.col("detections")))
            .withColumn("detection_count", F.when(frame % 3 != 0, F.col("detection_count"))))
    back = envelopes.parse_detection_messages(to_json_value(gaps), "value")
    return back.select("frame_id", "detection_count", F.size("detections").alias("n_detections"),
                       F.size(F.filter("detections", lambda d: d["class_name"] == "person")).alias("n_person"))


@query("regex_id_patch", KAFKA_SQL + """
, texts AS (
  SELECT event_id, topic, partition, "offset", key_text,
         '{"frame_id":' || CASE WHEN partition IN (0, 1) THEN ' ' ELSE '' END || '"", ' || substr(props, 2) AS raw_json
  FROM records)
SELECT event_id, raw_json,
       regexp_replace(raw_json, '"frame_id"\\s*:\\s*""',
         '"frame_id": "' || coalesce(key_text, topic || '-' || CAST(partition AS VARCHAR) || '-' || CAST("offset" AS VARCHAR)) || '"')
         AS patched_json
FROM texts""")
def regex_id_patch(spark, sf):
    rec = kafka_records(spark, sf).withColumn("props", F.decode("value", "UTF-8"))
    space = F.when(F.col("partition").isin(0, 1), F.lit(" ")).otherwise(F.lit(""))
    raw = F.concat(F.lit('{"frame_id":'), space, F.lit('"", '), F.expr("substr(props, 2)"))
    t = rec.select(F.col("offset").alias("event_id"), raw.alias("raw_json"),
                   envelopes.frame_key().alias("fk"))
    return t.select("event_id", "raw_json",
                    envelopes.patch_json_id(F.col("raw_json"), "frame_id", F.col("fk")).alias("patched_json"))


_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)"


@query("storage_usage_rollup", f"""
WITH p AS (SELECT regexp_extract(url, '{_HOST}', 1) AS host, html FROM pages),
q AS (SELECT regexp_extract(host, '[^.]+$', 0) AS tld, host, html FROM p)
SELECT tld, host, CAST(count(*) AS BIGINT) AS n_files, CAST(sum(octet_length(encode(html))) AS BIGINT) AS total_bytes
FROM q GROUP BY ROLLUP (tld, host)""")
def storage_usage_rollup(spark, sf):
    p = table(spark, sf, "pages").select("url", "html")
    host = F.regexp_extract("url", _HOST, 1)
    q = p.select(host.alias("host"), "html").withColumn("tld", F.regexp_extract("host", r"[^.]+$", 0))
    return files.usage_rollup(q, ["tld", "host"], F.octet_length("html"))
