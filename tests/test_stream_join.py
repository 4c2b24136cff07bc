"""Frames and detections as two streams against the same join of tables."""

import json

import pytest
from pyspark.sql import functions as F

from sightline.streaming.joins import frame_detections

@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


FRAMES = "camera_id string, frame_id long, s double, width int"
DETS = "camera_id string, frame_id long, d double, det_seq int"


def _rows():
    frames, dets = [], []
    for i in range(60):
        cam, t = f"cam{i % 3}", 10.0 * (i // 3) + i % 3
        frames.append((cam, i, t, 640))
        for k in range(i % 4):                                   # a quarter of the frames has none
            dets.append((cam, i, t + 0.5 + k, k))
        if i % 10 == 0:
            dets.append((cam, i, t + 500.0, 90))               # too long after its frame
        if i % 15 == 1:
            dets.append((cam, 1000 + i, t + 1.0, 91))          # of a frame that never comes
    frames += [("cam0", 999_000, 1.0, 1), ("cam0", 999_000, 1.0, 1)]      # a frame that comes twice
    dets += [("cam0", 999_000, 2.0, 1)]
    return sorted(frames, key=lambda r: r[2]), sorted(dets, key=lambda r: r[2])


def _tables(spark, frames, dets):
    f = spark.createDataFrame(frames, FRAMES).withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000)).drop("s")
    d = spark.createDataFrame(dets, DETS).withColumn("det_ts", F.timestamp_seconds(F.col("d") + 1_700_000_000)).drop("d")
    return f, d


def _chunks(df, ts, path, n):
    rows = df.orderBy(F.col(ts).asc_nulls_first()).collect()
    size = -(-len(rows) // n)
    for i in range(n):
        df.sparkSession.createDataFrame(rows[i * size:(i + 1) * size], df.schema).coalesce(1).write.parquet(f"{path}/c={i:03d}")


def _streams(spark, f, d, path, files):
    def read(df, name):
        return (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files)
                .option("recursiveFileLookup", "true").parquet(f"{path}/{name}"))
    return read(f, "f"), read(d, "d")


def _run(stream, name):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").start()
    q.processAllAvailable()
    progress = [json.loads(p.json) if hasattr(p, "json") and isinstance(p.json, str) else p for p in q.recentProgress]
    q.stop()
    return [tuple(r) for r in stream.sparkSession.table(name).collect()], progress


#: The last rows of a side only move its watermark: nobody's partner, later than all others.
END_F, END_D = ("end", -1, 100_000.0, 0), ("end", -2, 100_000.0, 0)


@pytest.mark.parametrize("how", ["inner", "left_outer", "full_outer"])
@pytest.mark.parametrize("files", [1, 4])
def test_stream_equals_batch(spark, tmp_dir, how, files):
    frames, dets = _rows()
    f, d = _tables(spark, frames + [END_F], dets + [END_D])
    _chunks(f, "ts", f"{tmp_dir}/f", 5)
    _chunks(d, "det_ts", f"{tmp_dir}/d", 5)
    sf, sd = _streams(spark, f, d, tmp_dir, files)
    args = dict(within="10 seconds", watermark="2000 seconds", how=how)
    got, progress = _run(frame_detections(sf, sd, **args), f"j_{how}_{files}")
    want = [tuple(r) for r in frame_detections(f, d, **args).collect()]
    own = [r for r in want if r[0] != "end"]
    assert sorted((r for r in got if r[0] != "end"), key=repr) == sorted(own, key=repr) and own
    # once the watermark has passed them, only the closing rows are held
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert held[-1] <= 2 < max(held)
    if how == "inner":
        f2, d2 = _tables(spark, frames, dets)
        assert len(got) == f2.join(d2, ["camera_id", "frame_id"]).where("det_seq <> 90").count()


def test_late_rows_and_bounded_state(spark, tmp_dir):
    """A long stream: the state holds what the delay and the range allow; a
    row later than the watermark is dropped, its frame goes out once."""
    n = 400
    frames = [("cam0", i, float(i), 1) for i in range(n)] + [END_F]
    dets = [("cam0", i, i + 0.5, 0) for i in range(n) if i != 7] + [END_D]
    f, d = _tables(spark, frames, dets)
    _chunks(f, "ts", f"{tmp_dir}/f", 10)
    _chunks(d, "det_ts", f"{tmp_dir}/d", 10)
    late = _tables(spark, frames[:1], [("cam0", 7, 7.5, 0)])[1]
    late.coalesce(1).write.parquet(f"{tmp_dir}/d/c=999")
    sf, sd = _streams(spark, f, d, tmp_dir, 1)
    got, progress = _run(frame_detections(sf, sd, within="5 seconds", watermark="20 seconds", how="left_outer"), "late")
    mine = sorted((r for r in got if r[0] == "cam0"), key=lambda r: r[1])
    assert [r[1] for r in mine] == list(range(n))               # each once
    assert [r[1] for r in mine if r[4] is None] == [7]          # its detection came too late
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(held) < n / 2


@pytest.mark.parametrize("how,n", [("inner", 0), ("left_outer", 2), ("right_outer", 2), ("full_outer", 4)])
def test_rows_without_key_or_time(spark, tmp_dir, how, n):
    f, d = _tables(spark, [(None, 1, 1.0, 5), ("cam0", 2, None, 5), END_F], [("cam0", None, 1.0, 5), ("cam0", 2, None, 5), END_D])
    batch = frame_detections(f, d, how=how).where("coalesce(camera_id, '') <> 'end'")
    assert batch.count() == n
    _chunks(f, "ts", f"{tmp_dir}/f", 1)
    _chunks(d, "det_ts", f"{tmp_dir}/d", 1)
    sf, sd = _streams(spark, f, d, tmp_dir, 1)
    got, progress = _run(frame_detections(sf, sd, how=how), f"nul_{how}")
    assert sorted((r for r in got if r[0] != "end"), key=repr) == sorted((tuple(r) for r in batch.collect()), key=repr)


def test_names_and_kinds(spark):
    f, d = _tables(spark, [END_F], [END_D])
    with pytest.raises(ValueError):
        frame_detections(f, d, how="anti")
    with pytest.raises(ValueError):
        frame_detections(f, d.withColumn("width", F.lit(1)))
