"""Canonical analytics tables over the parquet test tables.

The test data is a star schema; these adapters present it as the
camera tables the operators expect (see FIXTURES.md §3):

* ``frames``      one row per frame  (orders)
* ``detections``  one row per box    (lineitem joined to its frame)
* ``sightings``   one row per person sighting (events)
* ``vectors``     appearance embeddings (embeddings)

Each adapter reads only the columns it needs so the parquet scan is
pruned, and derives columns with built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def camera_of(key: Column, n_cameras: int = 7) -> Column:
    """'cam1'..'camN' from a non-negative integer key."""
    return F.concat(F.lit("cam"), (F.pmod(key, F.lit(n_cameras)) + 1).cast("string"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("frame_id"),
        camera_of(F.col("o_custkey")).alias("camera_id"),
        F.col("o_orderdate").alias("ts"),
        F.lit(1920).alias("width"),
        F.lit(1080).alias("height"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per detected box, numbered ``det_seq`` within its frame.

    Boxes are numbered on the line table alone (narrow rows through the
    shuffle); the numbering leaves the rows hash-partitioned by frame, so
    a sort-merge join with the frame table needs no second exchange of
    the boxes, and a small frame table is broadcast instead.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount")
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    x1 = (F.pmod(F.col("l_partkey"), F.lit(12)) * 15).cast("double")
    y1 = (F.pmod(F.col("l_suppkey"), F.lit(6)) * 20).cast("double")
    boxes = li.select(
        F.col("l_orderkey").alias("frame_id"),
        (F.row_number().over(w) - 1).cast("long").alias("det_seq"),
        x1.alias("x1"),
        y1.alias("y1"),
        (x1 + 20 + F.col("l_quantity")).alias("x2"),
        (y1 + 2 * (20 + F.col("l_quantity"))).alias("y2"),
        (F.round(F.col("l_discount") * 100).cast("int") / F.lit(10.0)).alias("confidence"),
        F.pmod(F.col("l_linenumber") - 1, F.lit(3)).cast("int").alias("class_id"),
    )
    f = frames(spark, sf_dir).select("frame_id", "camera_id", "ts")
    return boxes.join(f, "frame_id", "inner").select(
        "frame_id", "camera_id", "ts", "det_seq", "x1", "y1", "x2", "y2", "confidence", "class_id")


def detection_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes with the time at which their message arrives (the line's ship
    date), under the keys of their frame."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame_id"), F.col("l_shipdate").alias("det_ts"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"))
    f = frames(spark, sf_dir).select("frame_id", "camera_id")
    return li.join(f, "frame_id").select("frame_id", "camera_id", "det_ts", "line", "part", "supp")


# Event type -> camera of the sightings adapter.
EVENT_CAMERA = {"signup": "cam1", "view": "cam2", "click": "cam3", "purchase": "cam4"}
OTHER_CAMERA = "cam5"
# Fixed value: multiplier that scatters event ids over the 480 x 1440 grid.
POSITION_STRIDE = 7919
GRID_CELLS = 480 * 1440


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cam = F.lit(OTHER_CAMERA)
    for et, c in reversed(list(EVENT_CAMERA.items())):
        cam = F.when(F.col("event_type") == et, F.lit(c)).otherwise(cam)
    return ev.select(
        "event_id",
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("global_id"),
        cam.alias("camera_id"),
        "ts",
        (F.col("value") / 500).alias("confidence"),
        F.pmod(F.col("event_id") * POSITION_STRIDE, F.lit(GRID_CELLS)).cast("int").alias("position_id"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.select("vec_id", camera_of(F.col("vec_id")).alias("camera_id"), "embedding")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as Kafka-shaped records of per-camera detection topics.

    key: the person id as bytes, except error events whose producer sends
    no key (NULL, as real keyless producers do); value: the ``props`` JSON
    bytes; topic ``camN-detections`` from the user; partition ``user % 4``;
    offset ``event_id``; timestamp ``ts``.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return ev.select(
        F.when(F.col("event_type") != "error",
               F.encode(F.concat(F.lit("P"), F.col("user_id").cast("string")), "UTF-8")).alias("key"),
        F.encode(F.col("props"), "UTF-8").alias("value"),
        F.concat(camera_of(F.col("user_id")), F.lit("-detections")).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("event_type"),
    )
