"""File sources and source option maps."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sightline.sources import files
from sightline.sources.records import kafka_options, records


def _tree(root):
    for cam in (1, 2):
        os.makedirs(f"{root}/C{cam}", exist_ok=True)
        for n in (1, 2, 3):
            with open(f"{root}/C{cam}/{n:08d}.jpg", "wb") as fh:
                fh.write(b"\xff\xd8" + bytes(10 * n))
    with open(f"{root}/README.txt", "w") as fh:
        fh.write("x")


def test_frames_dir_and_listing(spark, tmp_dir):
    _tree(tmp_dir)
    fr = files.read_frames_dir(spark, tmp_dir).select("camera_id", "frame_id").collect()
    assert sorted((r.camera_id, r.frame_id) for r in fr) == [(f"cam{c}", n) for c in (1, 2) for n in (1, 2, 3)]
    listing = files.list_files(spark, tmp_dir)
    assert "content" not in listing.columns and listing.count() == 7
    roll = files.usage_rollup(listing.withColumn("dir", F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)),
                              ["dir"], F.col("length"))
    total = [r for r in roll.collect() if r.dir is None][0]
    assert total.n_files == 7 and total.total_bytes == 1 + 2 * (2 + 10) + 2 * (2 + 20) + 2 * (2 + 30)


def test_required_files_and_first_available(spark, tmp_dir):
    _tree(tmp_dir)
    miss = files.required_files_missing(spark, tmp_dir, ["C1/00000001.jpg", "C3/00000001.jpg"])
    assert [r.rel for r in miss.collect()] == ["C3/00000001.jpg"]
    assert files.first_available(spark, [f"{tmp_dir}/nope", tmp_dir]) == tmp_dir
    with pytest.raises(FileNotFoundError):
        files.first_available(spark, [f"{tmp_dir}/nope"])


def test_history_write_read_prunes(spark, tmp_dir):
    df = spark.createDataFrame([("cam1", 1, "2024-01-01 10:00:00"), ("cam2", 2, "2024-01-02 10:00:00"),
                                ("cam1", 3, "2024-01-03 10:00:00")], "camera_id string, frame_id long, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    files.write_history(df, f"{tmp_dir}/h")
    got = files.read_history(spark, f"{tmp_dir}/h", ["cam1"], "2024-01-01", "2024-01-02")
    assert [r.frame_id for r in got.collect()] == [1]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "camera_id" in plan


def test_json_documents_and_token_lines(spark, tmp_dir):
    with open(f"{tmp_dir}/a.json", "w") as fh:
        json.dump({"personID": 7, "views": [{"viewNum": 0, "xmin": 1, "ymin": 2}]}, fh, indent=2)
    docs = files.read_json_documents(spark, f"{tmp_dir}/a.json",
                                     "personID int, views array<struct<viewNum:int,xmin:int,ymin:int>>")
    r = docs.collect()[0]
    assert r.personID == 7 and r.views[0].xmin == 1 and r.source_file.endswith("a.json")
    with open(f"{tmp_dir}/r.pom", "w") as fh:
        fh.write("RECTANGLE 0 0 notvisible\nRECTANGLE 1 5 10 20 30 40\n\n")
    t = files.read_token_lines(spark, f"{tmp_dir}/r.pom", ["kind", "camera", "rect_id", "x1", "y1", "x2", "y2"],
                               ["string", "int", "int", "int", "int", "int", "int"]).collect()
    assert t[0].x1 is None and (t[1].camera, t[1].rect_id, t[1].x2) == (1, 5, 30)


def test_kafka_option_maps():
    o = kafka_options("b:9092", topics="cam1-frames", starting="latest", max_per_trigger=3)
    assert o["subscribe"] == "cam1-frames" and o["maxOffsetsPerTrigger"] == "3"
    assert o["failOnDataLoss"] == "false"
    p = kafka_options("b:9092", pattern=r"cam\d+-frames")
    assert "maxOffsetsPerTrigger" not in p and p["subscribePattern"] == r"cam\d+-frames"
    with pytest.raises(ValueError):
        kafka_options("b:9092")


def test_file_records_stream_cap(spark, tmp_dir):
    df = spark.createDataFrame([(None, b"v", "cam1-frames", 0, i, None) for i in range(4)],
                               "key binary, value binary, topic string, partition int, offset long, "
                               "timestamp timestamp")
    for i in range(4):
        df.where(F.col("offset") == i).write.parquet(f"{tmp_dir}/r/{i}")
    s = records(spark, "parquet", f"{tmp_dir}/r/*", stream=True, max_files_per_trigger=1)
    q = s.writeStream.format("memory").queryName("capped").start()
    q.processAllAvailable()
    n_batches = len([p for p in q.recentProgress if p["numInputRows"] > 0])
    q.stop()
    assert spark.table("capped").count() == 4 and n_batches == 4
