import json

from sightline.streaming.monitor import partition_lag, progress_frame, queue_sizes


def _update(batch, start, end, latest, kind="KafkaV2[Subscribe[cam1-frames]]"):
    return {"batchId": batch, "timestamp": f"2025-01-01T00:00:{batch:02d}.000Z", "numInputRows": 1,
            "inputRowsPerSecond": 1.0, "processedRowsPerSecond": 1.0, "durationMs": {"triggerExecution": 5},
            "sources": [{"description": kind, "startOffset": start, "endOffset": end, "latestOffset": latest}]}


def test_lag_by_topic_and_partition(spark):
    p = progress_frame(spark, [
        _update(0, None, {"t1": {"0": 5, "1": 7}}, {"t1": {"0": 9, "1": 7}}),
        _update(1, {"t1": {"0": 5, "1": 7}}, {"t1": {"0": 8, "1": 9}, "t2": {"0": 1}}, {"t1": {"0": 20, "1": 9}, "t2": {"0": 4}}),
        _update(2, {"logOffset": 1}, {"logOffset": 2}, None, "FileStreamSource[x]"),
        _update(3, {"t2": {"0": 1}}, {"t2": {"0": 2}}, None),
        {**_update(4, None, None, None), "sources": []}])
    got = sorted((r.batch_id, r.topic, r.partition, r.read, r.lag) for r in partition_lag(p).collect())
    assert [g[:3] for g in got] == [(0, "t1", 0), (0, "t1", 1), (1, "t1", 0), (1, "t1", 1), (1, "t2", 0), (3, "t2", 0)]
    assert [g[3:] for g in got] == [(None, 4), (None, 0), (3, 12), (2, 0), (None, 3), (1, None)]
    q = {r.topic: (r.queued, r.partitions, r.worst) for r in queue_sizes(p).collect()}
    assert q == {"t1": (12, 2, 12), "t2": (3, 1, 3)}


def test_files_have_no_topics(spark):
    p = progress_frame(spark, [_update(0, None, {"logOffset": 0}, {"logOffset": 0}, "FileStreamSource[x]")])
    assert json.loads(p.first().sources)[0]["endOffset"] == {"logOffset": 0}
    assert partition_lag(p).count() == 0 and queue_sizes(p).count() == 0
