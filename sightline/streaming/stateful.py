"""Event-time and stateful streaming operators.

Window aggregations use watermarks so state is dropped once a window
closes. Logic that depends on arrival order (the exact 1 s FPS flush,
latest-frame matching, per-camera track ids) is keyed state in
``applyInPandasWithState``: the state per key is a few numbers or the
currently active tracks, never the history. Spark hands a key's rows of one
micro-batch over in Arrow batches of ``maxRecordsPerBatch`` rows; they are
put together before they are ordered, so results do not depend on that
size. A micro-batch is bounded by the source's per-trigger cap.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sightline.operators.assignment import best_first


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session zone is UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def windowed_counts(stream: DataFrame, ts: str, width: str, watermark: str,
                    keys: Sequence[str] = (), slide: str | None = None) -> DataFrame:
    """Tumbling (or sliding) event-time counts, append mode safe."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    g = stream.withWatermark(ts, watermark).groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


def session_counts(stream: DataFrame, ts: str, gap: str, watermark: str,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Session windows (activity bursts separated by ``gap``)."""
    g = (stream.withWatermark(ts, watermark)
         .groupBy(*keys, F.session_window(ts, gap).alias("s")).agg(F.count(F.lit(1)).alias("n")))
    return g.select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def dedupe(stream: DataFrame, keys: Sequence[str], ts: str, watermark: str) -> DataFrame:
    """Drop replayed records (at-least-once sources) within the watermark."""
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


ACTIVE_OUT = "global_id string, last_ts timestamp, last_camera_id string"
ACTIVE_STATE = "last_ts timestamp, last_camera_id string"


def active_persons(stream: DataFrame, ts: str = "ts", watermark: str = "24 hours") -> DataFrame:
    """Latest camera and time per person (update mode). Of equal times
    the camera that sorts last counts. A person whose last sighting is older
    than the watermark leaves the state, and comes back with the next one."""
    def fn(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = tuple(state.get) if state.exists else None
        for pdf in pdfs:
            for r in pdf[["ts", "camera_id"]].dropna(subset=["ts"]).itertuples(index=False):
                now = (pd.Timestamp(r.ts), r.camera_id)
                if best is None or (now[0], now[1] or "") > (pd.Timestamp(best[0]), best[1] or ""):
                    best = now
        if best is None:
            return
        state.update(best)
        last_ms = int(pd.Timestamp(best[0]).value // 1_000_000)
        state.setTimeoutTimestamp(max(last_ms, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame([(k[0], *best)], columns=["global_id", "last_ts", "last_camera_id"])

    return (stream.withWatermark(ts, watermark).select("global_id", F.col(ts).alias("ts"), "camera_id")
            .groupBy("global_id")
            .applyInPandasWithState(fn, ACTIVE_OUT, ACTIVE_STATE, "update", GroupStateTimeout.EventTimeTimeout))


def crowd_alerts(stream: DataFrame, ts: str, width: str, watermark: str, limit: int) -> DataFrame:
    """Camera windows whose sightings reach ``limit`` (append mode)."""
    c = windowed_counts(stream, ts, width, watermark, ["camera_id"])
    return c.where(F.col("n") >= limit)


def _in_order(pdfs: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    """All rows of a key's micro-batch, ordered; ties keep their order."""
    return pd.concat(list(pdfs), ignore_index=True).sort_values(by, kind="stable")


# ------------------------------------------------------------ A4(b) / R6

FPS_OUT = "camera_id string, flush_ts timestamp, n long, fps double, cumulative long"
FPS_STATE = "start double, n long, cumulative long"


def _idle_after(state: GroupState, last_ms: int, idle_ms: int) -> None:
    """Let the state go once the watermark is ``idle_ms`` past its last row."""
    state.setTimeoutTimestamp(max(last_ms, state.getCurrentWatermarkMs()) + idle_ms)


def _millis(span: str) -> int:
    return max(1, int(pd.Timedelta(span).total_seconds() * 1000))


def fps_flush(stream: DataFrame, key: str = "camera_id", ts: str = "ts", interval_s: float = 1.0,
              watermark: str = "1 hour", idle: str = "1 hour") -> DataFrame:
    """Exact non-aligned FPS counter: count rows; once more than
    ``interval_s`` has passed since the counter started, emit
    ``n / elapsed``, add n to the cumulative total and restart the counter
    at that row. Rows are taken in event-time order within each trigger;
    rows without a time are not counted. A camera that is silent for ``idle``
    beyond the watermark leaves the state and starts anew.
    """
    idle_ms = _millis(idle)

    def fn(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        start, n, cum = state.get if state.exists else (None, 0, 0)
        out, last_ms = [], 0
        for t in _in_order(pdfs, [ts])[ts]:
            sec = pd.Timestamp(t).value / 1e9
            last_ms = int(sec * 1000)
            if start is None:
                start = sec
            n += 1
            elapsed = sec - start
            if elapsed > interval_s:
                cum += n
                out.append((k[0], pd.Timestamp(t), n, n / elapsed, cum))
                n, start = 0, sec
        state.update((start, n, cum))
        _idle_after(state, last_ms, idle_ms)
        yield pd.DataFrame(out, columns=["camera_id", "flush_ts", "n", "fps", "cumulative"])

    return (stream.where(F.col(ts).isNotNull()).withWatermark(ts, watermark)
            .select(F.col(key).alias("camera_id"), F.col(ts).alias(ts)).groupBy("camera_id")
            .applyInPandasWithState(fn, FPS_OUT, FPS_STATE, "append", GroupStateTimeout.EventTimeTimeout))


# ---------------------------------------------------------------- R7

MATCH_OUT = ("camera_id string, det_key string, det_ts timestamp, frame_id string, "
             "frame_ts timestamp")
MATCH_STATE = "frame_id string, frame_ts timestamp, frame_off long"


def latest_frame_match(frames: DataFrame, dets: DataFrame, watermark: str = "1 hour", idle: str = "1 hour") -> DataFrame:
    """Each detection message takes the camera's latest frame seen so far
    (by event time, then offset). Inputs: ``camera_id, ts, offset`` and
    ``frame_id`` (frames) / ``det_key`` (detections); rows without a time are
    left out. A camera that is silent for ``idle`` beyond the watermark
    leaves the state."""
    idle_ms = _millis(idle)
    f = frames.select("camera_id", "ts", "offset", F.col("frame_id").cast("string").alias("id"),
                      F.lit(0).alias("side"))
    d = dets.select("camera_id", "ts", "offset", F.col("det_key").cast("string").alias("id"),
                    F.lit(1).alias("side"))

    def fn(k, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        cur = state.get if state.exists else (None, None, None)
        out, last_ms = [], 0
        for r in _in_order(pdfs, ["ts", "side", "offset"]).itertuples(index=False):
            last_ms = int(pd.Timestamp(r.ts).value // 1_000_000)
            if r.side == 0:
                cur = (r.id, r.ts, int(r.offset))
            else:
                out.append((k[0], r.id, r.ts, cur[0], cur[1]))
        if cur[0] is not None:
            state.update(cur)
            _idle_after(state, last_ms, idle_ms)
        yield pd.DataFrame(out, columns=["camera_id", "det_key", "det_ts", "frame_id", "frame_ts"])

    return (f.unionByName(d).where("ts IS NOT NULL").withWatermark("ts", watermark).groupBy("camera_id")
            .applyInPandasWithState(fn, MATCH_OUT, MATCH_STATE, "append", GroupStateTimeout.EventTimeTimeout))


# ---------------------------------------------------------------- R8

TRACK_OUT = "camera_id string, frame_id long, det_seq long, local_id long"
TRACK_STATE = ("next_id long, ids array<long>, x1 array<double>, y1 array<double>, "
               "x2 array<double>, y2 array<double>, last array<long>")


def _iou_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    ix = np.maximum(0, np.minimum(a[:, None, 2], b[None, :, 2]) - np.maximum(a[:, None, 0], b[None, :, 0]))
    iy = np.maximum(0, np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1]))
    inter = ix * iy
    inter = np.where(np.isfinite(inter), inter, 0.0)
    area_a = np.maximum(0, a[:, 2] - a[:, 0]) * np.maximum(0, a[:, 3] - a[:, 1])
    area_b = np.maximum(0, b[:, 2] - b[:, 0]) * np.maximum(0, b[:, 3] - b[:, 1])
    union = area_a[:, None] + area_b[None, :] - inter
    return np.where(union > 0, inter / np.where(union > 0, union, 1), 0.0)


def local_track_ids(dets: DataFrame, iou_threshold: float = 0.3, grace_frames: int = 5,
                    timeout: str = "1 hour") -> DataFrame:
    """Per-camera local ids: boxes of a frame are matched greedily (IoU
    desc) to the camera's active tracks; unmatched boxes open new ids;
    tracks unseen for more than ``grace_frames`` frames are closed. Idle
    cameras lose their state after the event-time ``timeout``.

    Input: streaming ``camera_id, frame_id, det_seq, x1..y2, ts`` with a
    watermark on ``ts``.
    """
    def fn(k, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        if state.exists:
            nid, ids, *corners, last = state.get
            ids, last = np.asarray(ids, dtype=np.int64), np.asarray(last, dtype=np.int64)
            tracks = np.array([list(c) for c in corners], dtype=float).T.reshape(-1, 4)
        else:
            nid, ids, last, tracks = 0, np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 4))
        rows = _in_order(pdfs, ["frame_id", "det_seq"])
        frames, all_boxes = rows["frame_id"].to_numpy(), rows[["x1", "y1", "x2", "y2"]].to_numpy(dtype=float)
        given = np.empty(len(rows), dtype=np.int64)
        starts = np.flatnonzero(np.r_[True, frames[1:] != frames[:-1]])
        for at, end in zip(starts, np.r_[starts[1:], len(rows)]):
            fid, boxes = frames[at], all_boxes[at:end]
            keep = fid - last <= grace_frames
            ids, last, tracks = ids[keep], last[keep], tracks[keep]
            m = _iou_matrix(boxes, tracks)
            d, t = np.nonzero(m >= iou_threshold)                   # few of all pairs overlap enough
            order = np.lexsort((t, d, -m[d, t]))
            d, t = d[order], t[order]
            won = best_first(d, t, np.arange(len(d))) if len(d) else np.zeros(0, dtype=bool)
            track = np.full(len(boxes), -1)
            track[d[won]] = t[won]
            old, new = np.flatnonzero(track >= 0), np.flatnonzero(track < 0)
            fresh = nid + np.arange(len(new))
            nid += len(new)
            tracks[track[old]], last[track[old]] = boxes[old], fid
            given[at + old], given[at + new] = ids[track[old]], fresh
            ids, last = np.r_[ids, fresh], np.r_[last, np.full(len(new), fid)]
            tracks = np.concatenate([tracks, boxes[new]])
        state.update((int(nid), ids.tolist(), *[tracks[:, j].tolist() for j in range(4)], last.tolist()))
        state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + _millis(timeout))
        yield pd.DataFrame({"camera_id": k[0], "frame_id": frames, "det_seq": rows["det_seq"].to_numpy(), "local_id": given})

    return (dets.groupBy("camera_id")
            .applyInPandasWithState(fn, TRACK_OUT, TRACK_STATE, "append", GroupStateTimeout.EventTimeTimeout))
