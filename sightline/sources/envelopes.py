"""Record decoding (S3, S4, S6, T1, T11, T13, D1/D2/D5/D8/D11 fixes).

Everything here is an expression over the Kafka-shaped record columns
``key value topic partition offset timestamp``, so the same code runs on
a streaming Kafka source, a file stream or a batch table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import schemas
from sightline.operators.filters import jpeg_payload
from sightline.operators.matching import CLASS_NAMES
from sightline.sources.files import camera_of_topic


def frame_key(key: Column = None, topic: Column = None, partition: Column = None,
              offset: Column = None) -> Column:
    """A record id that is never NULL: the key, else topic-partition-offset."""
    key = F.col("key") if key is None else key
    topic = F.col("topic") if topic is None else topic
    partition = F.col("partition") if partition is None else partition
    offset = F.col("offset") if offset is None else offset
    return F.coalesce(key.cast("string"),
                      F.concat_ws("-", topic, partition.cast("string"), offset.cast("string")))


def record_metadata(records: DataFrame) -> DataFrame:
    """The metadata projection of a record stream."""
    return records.select(
        frame_key().alias("frame_key"),
        camera_of_topic(F.col("topic")).alias("camera_id"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition"),
        F.col("offset"),
    )


def parse_iso(ts_text: Column) -> Column:
    """ISO-8601 text (with or without fraction) to a zone-less timestamp."""
    return F.try_to_timestamp(ts_text).cast("timestamp_ntz")


def encode_base64(data: Column) -> Column:
    """Bytes to one-line base64 text (no MIME line breaks, whatever
    ``spark.sql.chunkBase64String.enabled`` says)."""
    return F.regexp_replace(F.base64(data), r"[\r\n]", "")


def decode_base64(text: Column) -> Column:
    """base64 text to bytes; NULL (not empty bytes) when it is not base64."""
    return F.try_to_binary(text, F.lit("base64"))


def parse_envelopes(records: DataFrame) -> DataFrame:
    """JSON frame envelopes to typed columns.

    Fields that are missing or cannot be read are null; ``sniff_frames`` says
    what is wrong with a record and routes it to the error output.
    """
    env = F.from_json(F.col("value").cast("string"), schemas.FRAME_ENVELOPE)
    out = records.withColumn("_sl_env", env)
    payload = decode_base64(F.col("_sl_env.data"))
    return out.select(
        "*",
        F.col("_sl_env.frame_id").alias("frame_id"),
        parse_iso(F.col("_sl_env.timestamp")).alias("frame_ts"),
        payload.alias("payload"),
    ).drop("_sl_env")


def sniff_frames(records: DataFrame) -> DataFrame:
    """One topic may carry raw JPEG bytes, their bare base64 text, or
    JSON envelopes.

    JPEG magic bytes => the value is the frame; text that decodes from base64
    to JPEG bytes => so is that. Otherwise the value must be an envelope whose
    ``data`` field (tested as a field: bad JSON gives a
    struct of NULLs, not a NULL struct) decodes from base64. Anything else
    keeps its raw bytes and gets an ``error`` text instead of a NULL row.
    """
    env = F.from_json(F.col("value").cast("string"), schemas.FRAME_ENVELOPE)
    is_jpeg = jpeg_payload(F.col("value"))
    decoded = decode_base64(env["data"])
    bare = decode_base64(F.col("value").cast("string"))
    is_bare = env["data"].isNull() & F.coalesce(jpeg_payload(bare), F.lit(False))
    payload = F.when(is_jpeg, F.col("value")).when(is_bare, bare).otherwise(decoded)
    error = (F.when(is_jpeg | is_bare, F.lit(None))
             .when(env["data"].isNull(), F.lit("not a frame envelope"))
             .when(decoded.isNull(), F.lit("payload is not base64"))
             .when(~jpeg_payload(decoded), F.lit("payload is not a JPEG image")))
    return records.select(
        frame_key().alias("frame_key"),
        camera_of_topic(F.col("topic")).alias("camera_id"),
        F.when(is_jpeg, F.lit(None)).otherwise(env["frame_id"]).alias("frame_id"),
        F.coalesce(parse_iso(env["timestamp"]), F.col("timestamp").cast("timestamp_ntz")).alias("ts"),
        payload.alias("payload"),
        error.alias("error"),
        F.col("value").alias("raw"),
    )


def normalise_detection(d: Column) -> Column:
    """Variants A/B/C of one detection to the canonical struct.

    B carries the class *name* under ``class``, C the class *id* under it.
    """
    cls = d["class"]
    cls_is_num = cls.rlike(r"^-?\d+$")
    class_id = F.coalesce(d["class_id"], F.when(cls_is_num, cls.try_cast("int")))
    class_name = F.coalesce(d["class_name"], F.when(~cls_is_num, cls))
    return F.struct(d["bbox"].alias("bbox"), d["confidence"].alias("confidence"),
                    class_id.alias("class_id"), class_name.alias("class_name"))


def parse_detection_messages(df: DataFrame, col: str = "value", default_class: str = "person",
                             names: dict[int, str] | None = None) -> DataFrame:
    """Detection-message JSON to a typed, defaulted struct.

    Defaults: a missing ``detections`` is an empty list; a missing
    ``class_name`` is that of the class id (``class_<id>`` for an unknown
    one), and ``person`` only if the id is missing too; ``error`` (D5) is a
    first-class field and ``detection_count`` falls back to the list size.
    """
    m = F.from_json(F.col(col).cast("string"), schemas.DETECTION_MESSAGE)
    dets = F.transform(F.coalesce(m["detections"], F.array()), normalise_detection)
    labels = F.create_map(*[F.lit(x) for pair in sorted((names or CLASS_NAMES).items()) for x in pair])
    dets = F.transform(dets, lambda d: d.withField("class_name", F.coalesce(
        d["class_name"], F.try_element_at(labels, d["class_id"]),
        F.concat(F.lit("class_"), d["class_id"].cast("string")), F.lit(default_class))))
    return df.withColumn("_sl_m", m).select(
        "*",
        F.col("_sl_m.camera_id").alias("camera_id"),
        F.col("_sl_m.frame_id").alias("frame_id"),
        parse_iso(F.col("_sl_m.timestamp")).alias("ts"),
        dets.alias("detections"),
        F.coalesce(F.col("_sl_m.detection_count"), F.size(dets)).alias("detection_count"),
        F.col("_sl_m.model").alias("model"),
        F.col("_sl_m.confidence_threshold").alias("confidence_threshold"),
        F.col("_sl_m.processing_node").alias("processing_node"),
        F.col("_sl_m.processing_time_ms").alias("processing_time_ms"),
        F.col("_sl_m.error").alias("error"),
    ).drop("_sl_m")


def patch_json_id(text: Column, field: str, value: Column) -> Column:
    """Fill an empty id field whatever the spacing after the colon.
    The value is written as a JSON string; a null one leaves the text as it is."""
    pattern = '"' + field + r'"\s*:\s*""'
    quoted = F.to_json(F.struct(value.cast("string").alias("v")))                 # {"v":"..."}
    quoted = F.substr(quoted, F.lit(6), F.length(quoted) - 6)
    literal = F.replace(F.replace(quoted, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    filled = F.regexp_replace(text, F.lit(pattern), F.concat(F.lit('"' + field + '": '), literal))
    return F.when(value.isNull(), text).otherwise(filled)
