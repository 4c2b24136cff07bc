"""Streaming: stream = batch, stateful operators, the scoring job end to end."""

import base64
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from sightline.operators.scoring import StubScorer
from sightline.operators.stats import tumbling_rate
from sightline.sources.tables import sightings
from sightline.streaming import stateful
from sightline.streaming.job import JobConfig, start
from tests.conftest import SF_SMALL


def _write_chunks(df, path, n):
    """Split rows into n time-ordered parquet files."""
    rows = df.orderBy("event_id").collect()
    size = (len(rows) + n - 1) // n
    for i in range(n):
        part = rows[i * size:(i + 1) * size]
        if part:
            df.sparkSession.createDataFrame(part, df.schema).coalesce(1).write.parquet(f"{path}/chunk={i:03d}")
    return glob.glob(f"{path}/chunk=*")


def _drain(spark, stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


@pytest.mark.parametrize("files_per_trigger", [1, 3])
def test_windowed_stream_equals_batch(spark, tmp_dir, files_per_trigger):
    s = stateful.event_time(sightings(spark, SF_SMALL)).select("event_id", "camera_id", "ts")
    src = f"{tmp_dir}/src"
    _write_chunks(s, src, 6)
    stream = (spark.readStream.schema(s.schema).option("maxFilesPerTrigger", files_per_trigger)
              .option("recursiveFileLookup", "true").parquet(src))
    out = _drain(spark, stateful.windowed_counts(stream, "ts", "1 hour", "0 seconds", ["camera_id"]),
                 f"win_{files_per_trigger}")
    batch = tumbling_rate(s, "ts", "1 hour", 3600, ["camera_id"]).select(
        "camera_id", "window_start", "window_end", "n")
    max_ts = s.agg(F.max("ts")).collect()[0][0]
    closed = batch.where(F.col("window_end") <= F.lit(max_ts))
    got = sorted(tuple(r) for r in out.collect())
    want = sorted(tuple(r) for r in closed.collect())
    assert got == want and len(got) > 0


def test_fps_flush_exact(spark, tmp_dir):
    secs = [0.0, 0.5, 1.0, 1.2, 2.0, 2.3, 3.5]
    df = spark.createDataFrame([("cam1", s) for s in secs], "camera_id string, s double") \
        .select("camera_id", F.timestamp_seconds(F.col("s") + 1000).alias("ts"))
    df.write.parquet(f"{tmp_dir}/fps")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/fps")
    out = _drain(spark, stateful.fps_flush(stream), "fps").orderBy("flush_ts").collect()
    assert [(r.n, round(r.fps, 6), r.cumulative) for r in out] == \
        [(4, round(4 / 1.2, 6), 4), (2, round(2 / 1.1, 6), 6), (1, round(1 / 1.2, 6), 7)]


def test_idle_cameras_leave_the_state(spark, tmp_dir):
    """A camera that falls silent is forgotten, and counts anew when it returns."""
    t0 = 1_700_000_000
    batches = [[("a", 0.0), ("a", 0.5), ("b", 0.0)], [("b", 8000.0), ("b", 8000.5)], [("b", 16000.0)], [("a", 16001.0), ("a", 16003.0)],
               [("b", 16004.0)]]
    schema = "camera_id string, s double"
    for i, rows in enumerate(batches):
        (spark.createDataFrame(rows, schema).select("camera_id", F.timestamp_seconds(F.col("s") + t0).alias("ts"))
         .coalesce(1).write.parquet(f"{tmp_dir}/idle/c={i}"))
    src = (spark.readStream.schema("camera_id string, ts timestamp").option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/idle"))
    q = stateful.fps_flush(src, watermark="10 seconds", idle="100 seconds").writeStream.format("memory") \
        .queryName("idle").outputMode("append").start()
    q.processAllAvailable()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    q.stop()
    assert 1 in held[1:-1]                                     # only b was held for a while
    rows = [(r.camera_id, r.n, r.cumulative) for r in spark.table("idle").where("camera_id = 'a'").collect()]
    assert rows == [("a", 2, 2)]                              # the two rows before its silence are gone


def test_latest_frame_match_ties_take_higher_offset(spark, tmp_dir):
    frames = spark.createDataFrame(
        [("cam1", 10, 1, "f1"), ("cam1", 10, 2, "f2"), ("cam1", 20, 3, "f3")],
        "camera_id string, s long, offset long, frame_id string").withColumn("ts", F.timestamp_seconds("s"))
    dets = spark.createDataFrame([("cam1", 10, 7, "d1"), ("cam1", 25, 8, "d2"), ("cam1", 5, 9, "d0")],
                                 "camera_id string, s long, offset long, det_key string") \
        .withColumn("ts", F.timestamp_seconds("s"))
    frames.write.parquet(f"{tmp_dir}/f")
    dets.write.parquet(f"{tmp_dir}/d")
    fs = spark.readStream.schema(frames.schema).parquet(f"{tmp_dir}/f")
    ds = spark.readStream.schema(dets.schema).parquet(f"{tmp_dir}/d")
    out = {r.det_key: r.frame_id for r in _drain(spark, stateful.latest_frame_match(fs, ds), "m").collect()}
    assert out == {"d0": None, "d1": "f2", "d2": "f3"}


def test_local_track_ids_follow_a_box(spark, tmp_dir):
    rows = [("cam1", 1, 0, 0.0, 0.0, 10.0, 10.0), ("cam1", 1, 1, 50.0, 50.0, 60.0, 60.0),
            ("cam1", 2, 0, 51.0, 51.0, 61.0, 61.0), ("cam1", 2, 1, 1.0, 1.0, 11.0, 11.0),
            ("cam1", 9, 0, 1.0, 1.0, 11.0, 11.0)]
    df = spark.createDataFrame(rows, "camera_id string, frame_id long, det_seq long, x1 double, y1 double, "
                                     "x2 double, y2 double").withColumn("ts", F.timestamp_seconds("frame_id"))
    df.write.parquet(f"{tmp_dir}/t")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/t").withWatermark("ts", "1 hour")
    out = {(r.frame_id, r.det_seq): r.local_id for r in
           _drain(spark, stateful.local_track_ids(stream, grace_frames=5), "tracks").collect()}
    assert out[(2, 1)] == out[(1, 0)] and out[(2, 0)] == out[(1, 1)]
    assert out[(9, 0)] not in (out[(1, 0)], out[(1, 1)])       # lost beyond the grace period


def test_dedupe_replayed_records(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, s long") \
        .withColumn("ts", F.timestamp_seconds("s"))
    df.write.parquet(f"{tmp_dir}/dup")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/dup")
    assert _drain(spark, stateful.dedupe(stream, ["k"], "ts", "1 hour"), "dd").count() == 2


RECORD = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"


def _records(spark, start_offset):
    jpeg = b"\xff\xd8" + b"x" * 3
    env = json.dumps({"frame_id": "e1", "timestamp": "2025-01-01T00:00:01",
                      "data": base64.b64encode(jpeg).decode()}).encode()
    return spark.createDataFrame([
        (None, jpeg, "cam1-frames", 0, start_offset, None),
        (None, env, "cam2-frames", 0, start_offset + 1, None),
        (None, b"junk", "cam2-frames", 0, start_offset + 2, None)], RECORD)


def test_scoring_job_once_per_batch_and_restart(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _records(spark, 0).write.parquet(f"{src}/a")
    schema = _records(spark, 0).schema

    def run():
        stream = (spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src))
        q = start(stream, JobConfig(out_dir=out, checkpoint=ck, available_now=True))
        q.awaitTermination(120)

    run()
    msgs = spark.read.parquet(f"{out}/messages")
    errs = spark.read.parquet(f"{out}/errors")
    assert msgs.count() == 2 and errs.count() == 1
    assert {r.detection_count for r in msgs.collect()} == {1}          # len 5 % 4 = 1 box
    assert errs.collect()[0].error == "not a frame envelope"
    run()                                                               # restart: nothing new
    assert spark.read.parquet(f"{out}/messages").count() == 2
    _records(spark, 100).write.parquet(f"{src}/b")
    run()                                                               # only the new file
    assert spark.read.parquet(f"{out}/messages").count() == 4
    assert len([d for d in os.listdir(f"{out}/messages") if d.startswith("batch_id=")]) == 2


def test_sessions_alerts_and_active_persons(spark, tmp_dir):
    rows = [("P1", "cam1", 0), ("P1", "cam2", 60), ("P1", "cam2", 4000), ("P2", "cam1", 30),
            ("P2", "cam1", 90), ("P3", "cam1", 100), ("P9", "cam3", 20000)]
    df = spark.createDataFrame(rows, "global_id string, camera_id string, s long") \
        .withColumn("ts", F.timestamp_seconds("s"))
    df.write.parquet(f"{tmp_dir}/s")
    schema = df.schema

    def stream():
        return spark.readStream.schema(schema).parquet(f"{tmp_dir}/s")
    sess = _drain(spark, stateful.session_counts(stream(), "ts", "10 minutes", "0 seconds", ["global_id"]), "sess")
    got = sorted((r.global_id, r.n) for r in sess.collect())
    # {0, 60} then {4000}; P2: {30, 90}; P3: {100}; P9's session is still open
    assert got == [("P1", 1), ("P1", 2), ("P2", 2), ("P3", 1)]
    alerts = _drain(spark, stateful.crowd_alerts(stream(), "ts", "1 hour", "0 seconds", 4), "alerts").collect()
    assert [(r.camera_id, r.n) for r in alerts] == [("cam1", 4)]
    act = _drain(spark, stateful.active_persons(stream()), "active", mode="update")
    last = {r.global_id: r.last_camera_id for r in act.collect()}
    assert last == {"P1": "cam2", "P2": "cam1", "P3": "cam1", "P9": "cam3"}


def test_per_frame_scoring_errors_do_not_stop_the_batch(spark):
    from sightline.operators.scoring import StubScorer, score_frames

    class OneAtATime:                      # a scorer without score_batch
        def __init__(self):
            self.m = StubScorer()

        def score(self, p):
            return self.m.score(p)
    frames = spark.createDataFrame([("cam1", 1, b"\xff\xd8abc"), ("cam1", 2, b"GIF89a")],
                                   "camera_id string, frame_id long, payload binary") \
        .withColumn("ts", F.current_timestamp())
    out = {r.frame_id: r for r in score_frames(frames, OneAtATime).collect()}
    assert out["1"].error is None and len(out["1"].confidence) == 1        # 5 bytes % 4
    assert out["2"].error.startswith("ValueError") and out["2"].confidence == []
    assert out["1"].processing_node.startswith("spark-worker-")


def test_progress_log_holds_every_update(spark, tmp_dir):
    """The listener's table has all updates, also those Spark has dropped."""
    import time

    from sightline.streaming.monitor import ProgressLog, backlog
    df = spark.range(30).withColumn("ts", F.timestamp_seconds("id"))
    df.repartition(6).write.parquet(f"{tmp_dir}/pl")
    keep = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    log = ProgressLog(spark, f"{tmp_dir}/progress")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    spark.streams.addListener(log)
    try:
        q = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/pl")
             .writeStream.format("noop").trigger(availableNow=True).start())
        q.awaitTermination(60)
        n = q.lastProgress.batchId + 1
        for _ in range(100):
            if len(glob.glob(f"{tmp_dir}/progress/part-*")) >= n:
                break
            time.sleep(0.2)
        assert len(q.recentProgress) <= 2
    finally:
        spark.streams.removeListener(log)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", keep)
    rows = sorted(backlog(spark.read.parquet(f"{tmp_dir}/progress")).collect(), key=lambda r: r.batch_id)
    assert [r.batch_id for r in rows] == list(range(n)) and n >= 6
    total = 0.0
    for r in rows:
        total += r.batch_backlog
        assert abs(r.running_backlog - total) < 1e-6


def test_progress_frame_and_backlog(spark, tmp_dir):
    from sightline.streaming.monitor import backlog, progress_frame
    df = spark.createDataFrame([(i,) for i in range(30)], "v long")
    for i in range(3):
        df.where(F.col("v") % 3 == i).coalesce(1).write.parquet(f"{tmp_dir}/p/{i}")
    s = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/p/*")
    q = s.writeStream.format("memory").queryName("prog").start()
    q.processAllAvailable()
    prog = progress_frame(spark, q.recentProgress)
    q.stop()
    rows = prog.where("input_rows > 0").collect()
    assert sum(r.input_rows for r in rows) == 30 and len(rows) == 3
    assert backlog(prog).count() == prog.count()


def test_fan_out_feeds_every_sink_from_one_batch(spark, tmp_dir):
    from sightline.streaming.sinks import fan_out, parquet_batch_sink
    df = spark.createDataFrame([("cam1", i) for i in range(10)], "camera_id string, v long")
    df.coalesce(1).write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/in")
    run = fan_out({
        "rows": (lambda b: b, parquet_batch_sink(f"{tmp_dir}/rows")),
        "counts": (lambda b: b.groupBy("camera_id").count(), parquet_batch_sink(f"{tmp_dir}/counts")),
    })
    q = stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{tmp_dir}/ck") \
        .trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/rows").count() == 10
    assert spark.read.parquet(f"{tmp_dir}/counts").collect()[0]["count"] == 10


def test_order_does_not_depend_on_arrow_batches(spark, tmp_dir):
    """One camera's rows come in several Arrow batches of a micro-batch; the
    flush and the match equal those of one batch."""
    import random
    rnd = random.Random(1)
    t = sorted(rnd.random() * 30 for _ in range(200))
    rnd.shuffle(t)
    df = spark.createDataFrame([("cam1", x, i) for i, x in enumerate(t)], "camera_id string, s double, i long") \
        .withColumn("ts", F.timestamp_micros((F.col("s") * 1e6).cast("long"))).withColumn("offset", F.col("i")) \
        .withColumn("frame_id", F.col("i").cast("string")).withColumn("det_key", F.col("i").cast("string"))
    df.coalesce(1).write.parquet(f"{tmp_dir}/o")
    keep = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = []
    try:
        for size in ("5", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/o")
            fps = _drain(spark, stateful.fps_flush(stream), f"fps{size}").collect()
            m = _drain(spark, stateful.latest_frame_match(stream.where("i % 2 = 0"), stream.where("i % 2 = 1")), f"m{size}").collect()
            got.append((sorted(map(tuple, fps)), sorted(map(tuple, m))))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", keep)
    assert got[0] == got[1]
    fps, m = got[0]
    # batch twin of the flush
    rows, start, n, cum = [], None, 0, 0
    for x in sorted(int(v * 1e6) for v in t):
        start = x if start is None else start
        n += 1
        if x - start > 1_000_000:
            cum += n
            rows.append((n, cum))
            start, n = x, 0
    assert [(r[2], r[4]) for r in fps] == rows
    last = {}
    frames = sorted((int(x * 1e6), str(i)) for i, x in enumerate(t) if i % 2 == 0)
    for i, x in enumerate(t):
        if i % 2:
            before = [f for s, f in frames if s <= int(x * 1e6)]
            last[str(i)] = before[-1] if before else None
    assert {r[1]: r[3] for r in m} == last


def test_published_messages_are_read_back_whole(spark, tmp_dir):
    """What the job publishes gives every field to the repo's own parser;
    empty messages can be left out."""
    from sightline.sources.envelopes import parse_detection_messages
    _records(spark, 0).withColumn("timestamp", F.lit("2025-01-02 03:04:05.678901").cast("timestamp")) \
        .write.parquet(f"{tmp_dir}/p")
    schema = _records(spark, 0).schema
    for only in (False, True):
        sent = f"{tmp_dir}/sent{only}"
        stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/p")
        q = start(stream, JobConfig(out_dir=f"{tmp_dir}/po{only}", checkpoint=f"{tmp_dir}/pc{only}", available_now=True,
                                    kafka_brokers="none", kafka_topic="t", only_nonempty=only, monitor_rows=2,
                                    publish=lambda kv, _b, _t: kv.write.mode("append").parquet(sent)))
        q.awaitTermination(120)
        back = {r.camera_id: r for r in parse_detection_messages(spark.read.parquet(sent)).collect()}
        r = back["cam1"]
        assert str(r.ts) == "2025-01-02 03:04:05.678901" and r.processing_node.startswith("spark-worker-")
        assert r.processing_time_ms >= 0 and r.error is None and r.model == "stub-v1"
        assert r.confidence_threshold == 0.5 and r.detection_count == 1 == len(r.detections)
        d = r.detections[0]
        assert (d.bbox, d.confidence, d.class_id, d.class_name) == ([0.0, 0.0, 50.0, 100.0], 0.9, 0, "person")


def test_a_failing_batch_is_scored_frame_by_frame(spark):
    from sightline.operators.scoring import score_frames

    class Fragile:
        def score_batch(self, payloads):
            if any(p == b"bad" for p in payloads):
                raise RuntimeError("batch failed")
            return StubScorer().score_batch(payloads)

    class FragileWithScore(Fragile):
        def score(self, payload):
            return StubScorer().score(payload)

    frames = spark.createDataFrame([("c", str(i), b"bad" if i == 3 else b"\xff\xd8xxx") for i in range(6)],
                                   "camera_id string, frame_id string, payload binary") \
        .withColumn("ts", F.current_timestamp())
    for make, text in ((Fragile, "RuntimeError: batch failed"), (FragileWithScore, "ValueError: payload is not a JPEG image")):
        out = {r.frame_id: r for r in score_frames(frames.coalesce(1), make).collect()}
        assert {k for k, r in out.items() if r.error} == {"3"} and out["3"].error == text
        assert all(len(r.x1) == 1 for k, r in out.items() if k != "3")
