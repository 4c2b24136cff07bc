"""Frames with their own detections, both as streams.

``frame_detections`` pairs a frame with the detections of its key whose time
lies from the frame's time to ``within`` after it. Both sides carry
watermarks, and the time range lets Spark drop a row from the state as soon
as no partner can come any more: a frame once the detections' watermark has
passed its time plus ``within``, a detection once the frames' watermark has
passed its own time. In the outer forms that is also when a row that met
nobody goes out, once, with nulls. So the state holds what arrived within
the watermarks' delays and the range, whatever the length of the stream.

Rows later than their side's watermark are dropped by the engine, as
everywhere in event time. A row without a key or time meets nobody: where
its side is kept it goes out at once, else it goes, and it never enters the
state. Rows that a source replays are rows of their own; ``stateful.dedupe``
takes them out before.

The function takes batch tables as well: there it is the same join, and a
stream gives what the batch gives once its watermarks have passed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How -> sides whose rows without a partner are kept.
KEPT = {"inner": (), "left_outer": ("left",), "right_outer": ("right",), "full_outer": ("left", "right")}


def _known(df: DataFrame, cols: Sequence[str]) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    return ok


def frame_detections(frames: DataFrame, dets: DataFrame, keys: Sequence[str] = ("camera_id", "frame_id"),
                     frame_ts: str = "ts", det_ts: str = "det_ts", within: str = "10 seconds",
                     watermark: str = "30 seconds", det_watermark: str | None = None, how: str = "inner") -> DataFrame:
    """Keys, then the frame's columns, then the detection's. Apart from the
    keys, the two sides share no column name; times are timestamps."""
    if how not in KEPT:
        raise ValueError(f"how must be one of {sorted(KEPT)}")
    keys = list(keys)
    shared = (set(frames.columns) & set(dets.columns)) - set(keys)
    if shared:
        raise ValueError(f"both sides have {sorted(shared)}")
    f_cols = [c for c in frames.columns if c not in keys]
    d_cols = [c for c in dets.columns if c not in keys]
    f_ok, d_ok = _known(frames, [*keys, frame_ts]), _known(dets, [*keys, det_ts])
    f = frames.where(f_ok).withWatermark(frame_ts, watermark)
    d = dets.where(d_ok).withWatermark(det_ts, det_watermark or watermark)
    f = f.select(*[F.col(k).alias("_f_" + k) for k in keys], *f_cols)
    d = d.select(*[F.col(k).alias("_d_" + k) for k in keys], *d_cols)
    on = F.col(det_ts).between(F.col(frame_ts), F.col(frame_ts) + F.expr(f"INTERVAL {within}"))
    for k in keys:
        on = on & (F.col("_f_" + k) == F.col("_d_" + k))
    out = f.join(d, on, how).select(*[F.coalesce("_f_" + k, "_d_" + k).alias(k) for k in keys], *f_cols, *d_cols)
    if "left" in KEPT[how]:
        out = out.unionByName(frames.where(~f_ok), allowMissingColumns=True)
    if "right" in KEPT[how]:
        out = out.unionByName(dets.where(~d_ok), allowMissingColumns=True)
    return out
