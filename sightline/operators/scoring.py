"""Distributed batch scoring of frames.

A scorer is any object with ``score(payload: bytes) -> list of
(x1, y1, x2, y2, confidence, class_id)``. ``score_frames`` runs it with
``mapInArrow``: the scorer is built once per task (the per-worker model
cache), each Arrow batch is scored in place, the time per frame is
measured, failures become an ``error`` value on that frame only, and the
output is typed columns (no JSON round trip). Scoring has no side
effects, so a retried task simply recomputes its rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.text import NODE_PREFIX
from sightline.operators.filters import DetectionPolicy
from sightline.operators.shapes import jpeg_shape

SCORED_SCHEMA = ("camera_id string, frame_id string, ts timestamp_ntz, x1 array<double>, y1 array<double>, "
                 "x2 array<double>, y2 array<double>, confidence array<double>, class_id array<int>, "
                 "processing_node string, processing_time_ms double, error string, frame_shape array<int>")

JPEG_MAGIC = b"\xff\xd8"


class StubScorer:
    """Deterministic numpy stand-in for a detector (no model weights here).

    Frame ``p`` yields ``len(p) % 4`` boxes; box ``i`` is
    ``[10i, 10i, 10i + 50, 10i + 100]`` with confidence ``0.9 - 0.2 i``
    and class ``i % classes``. Bytes that are not a JPEG raise, as a decoder would.
    ``score_batch`` is the vectorised form a batching model would offer.
    """

    def __init__(self, classes: int = 1):
        self.classes = classes

    def score(self, payload: bytes):
        if payload is None or payload[:2] != JPEG_MAGIC:
            raise ValueError("payload is not a JPEG image")
        n = len(payload) % 4
        i = np.arange(n, dtype=np.float64)
        return list(zip(10 * i, 10 * i, 10 * i + 50, 10 * i + 100, 0.9 - 0.2 * i, i % self.classes))

    def score_batch(self, payloads):
        """-> (boxes per frame as an (n, 6) array, error text per frame)."""
        out, errs = [], []
        table = [np.column_stack([10 * i, 10 * i, 10 * i + 50, 10 * i + 100, 0.9 - 0.2 * i, i % self.classes])
                 for i in (np.arange(k, dtype=np.float64) for k in range(4))]
        for p in payloads:
            if p is None or p[:2] != JPEG_MAGIC:
                out.append(table[0])
                errs.append("ValueError: payload is not a JPEG image")
            else:
                out.append(table[len(p) % 4])
                errs.append(None)
        return out, errs


class _OneByOne:
    """A scorer that only scores batches, one frame at a time."""

    def __init__(self, model):
        self.score_batch = model.score_batch

    def score(self, payload):
        boxes, errors = self.score_batch([payload])
        if errors[0]:
            raise ValueError(errors[0])
        return boxes[0]


def score_frames(frames: DataFrame, scorer_factory: Callable[[], object] = StubScorer,
                 policy: DetectionPolicy | None = None, spread_over: int | None = None) -> DataFrame:
    """Frames (camera_id, frame_id, ts, payload) -> one scored row per frame.

    Detections come back as parallel arrays; ``detections_struct`` turns
    them into the message form and ``explode_scored`` into one row per box.
    Frames are scored where they lie, without a shuffle. Scoring is the
    expensive per-row step, so a caller whose source has few partitions may
    name the number to spread them over round-robin (``spread_over``).

    A batch that the scorer fails on is scored again frame by frame, so the
    error stays with the frames that cause it.
    """
    if spread_over:
        frames = frames.repartition(spread_over)
    policy = policy or DetectionPolicy(0.0)
    thr = float(policy.threshold)
    classes = None if policy.classes is None else list(policy.classes)
    src = frames.select(F.col("camera_id"), F.col("frame_id").cast("string").alias("frame_id"),
                        F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("payload"))

    def boxes_of(model, batched: bool, payloads: list) -> tuple[list[np.ndarray], list, list[float]]:
        """Boxes, error and milliseconds of every frame."""
        if batched:
            t0 = time.perf_counter()
            try:
                boxes, errs = model.score_batch(payloads)
                return boxes, errs, [(time.perf_counter() - t0) * 1000.0 / max(1, len(payloads))] * len(payloads)
            except Exception:                             # noqa: BLE001 - find the frames that cause it below
                if not hasattr(model, "score"):
                    model = _OneByOne(model)
        boxes, errs, times = [], [], []
        for payload in payloads:
            t0 = time.perf_counter()
            try:
                b = np.asarray(model.score(payload), dtype=np.float64).reshape(-1, 6)
                err = None
            except Exception as e:                        # noqa: BLE001 - one bad frame must not stop the stream
                b, err = np.zeros((0, 6)), f"{type(e).__name__}: {e}"
            times.append((time.perf_counter() - t0) * 1000.0)
            boxes.append(b)
            errs.append(err)
        return boxes, errs, times

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        node = f"{NODE_PREFIX}{ctx.partitionId() if ctx else 0}"
        model = scorer_factory()                          # once per task
        batched = hasattr(model, "score_batch")
        for batch in batches:
            payloads = batch.column("payload").to_pylist()
            boxes, errs, times = boxes_of(model, batched, payloads)
            # all boxes of the batch are tested at once; offsets say whose they are
            flat = np.concatenate([np.zeros((0, 6)), *boxes])
            frame = np.repeat(np.arange(len(boxes)), [len(b) for b in boxes])
            good = flat[:, 4] >= thr
            if classes is not None:
                good &= np.isin(flat[:, 5].astype(int), classes)
            flat, frame = flat[good], frame[good]
            ends = pa.array(np.searchsorted(frame, np.arange(len(boxes) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(flat[:, j]))) for j in range(5)]
            lists.append(pa.ListArray.from_arrays(ends, pa.array(flat[:, 5].astype(np.int32))))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("camera_id", "frame_id", "ts")], *lists,
                 pa.array([node] * len(boxes), type=pa.string()), pa.array(times, type=pa.float64()),
                 pa.array(errs, type=pa.string()), pa.array([jpeg_shape(p) for p in payloads], type=pa.list_(pa.int32()))],
                names=["camera_id", "frame_id", "ts", "x1", "y1", "x2", "y2", "confidence", "class_id",
                       "processing_node", "processing_time_ms", "error", "frame_shape"])

    return src.mapInArrow(run, SCORED_SCHEMA)


def detections_struct(scored: DataFrame) -> DataFrame:
    """Scored arrays -> ``detections array<struct>`` message form."""
    z = F.arrays_zip("x1", "y1", "x2", "y2", "confidence", "class_id")
    dets = F.transform(z, lambda d: F.struct(
        F.array(d["x1"], d["y1"], d["x2"], d["y2"]).alias("bbox"),
        d["confidence"].alias("confidence"), d["class_id"].alias("class_id")))
    return scored.select("camera_id", "frame_id", "ts", dets.alias("detections"),
                         F.size("confidence").alias("detection_count"),
                         "processing_node", "processing_time_ms", "error", "frame_shape")


def explode_scored(scored: DataFrame) -> DataFrame:
    """Scored arrays -> canonical detections rows (``det_seq`` = box order)."""
    z = F.arrays_zip("x1", "y1", "x2", "y2", "confidence", "class_id")
    e = scored.select("camera_id", "frame_id", "ts", F.posexplode(z).alias("det_seq", "d"))
    return e.select("camera_id", "frame_id", "ts", F.col("det_seq").cast("long"),
                    *[F.col("d")[c].alias(c) for c in ("x1", "y1", "x2", "y2", "confidence", "class_id")])
