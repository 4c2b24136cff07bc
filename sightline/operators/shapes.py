"""Frame shapes from JPEG headers.

A JPEG says its size in the frame header, which follows segments of any
length. ``jpeg_shape`` walks the markers without decoding the picture;
``with_frame_shape`` does so in Arrow batches, on the payload column alone.
Boxes found on a resized input are brought back to the published frame with
the two shapes (``boxes_on_frame``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.geometry import fit_inside, rescale

#: Markers without a length; frame headers are C0 to CF but for
#: C4, C8 and CC; a scan (DA) or the end (D9) comes after the frame header.
_BARE = {0x01, *range(0xD0, 0xD8)}
_FRAME = set(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def jpeg_shape(payload: bytes | None) -> tuple[int, int, int] | None:
    """(height, width, channels), or None if there is no whole frame header."""
    if payload is None or payload[:2] != b"\xff\xd8":
        return None
    at, end = 2, len(payload)
    while at + 1 < end:
        if payload[at] != 0xFF:
            return None
        marker = payload[at + 1]
        if marker == 0xFF:                                   # fill byte
            at += 1
            continue
        at += 2
        if marker in _BARE:
            continue
        if marker in (0xD9, 0xDA) or at + 2 > end:
            return None
        size = int.from_bytes(payload[at:at + 2], "big")
        if size < 2:
            return None
        if marker in _FRAME:
            if size < 8 or at + 8 > end:
                return None
            h, w = int.from_bytes(payload[at + 3:at + 5], "big"), int.from_bytes(payload[at + 5:at + 7], "big")
            c = payload[at + 7]
            return (h, w, c) if h and w and c else None
        at += size
    return None


def frame_shape(payload: Column) -> Column:
    """[height, width, channels] of a JPEG; null if its header is malformed."""
    @F.pandas_udf("array<int>")
    def shape(p: pd.Series) -> pd.Series:
        return p.map(lambda b: None if b is None else jpeg_shape(bytes(b)))
    return shape(payload)


def with_frame_shape(frames: DataFrame, payload: str = "payload", out: str = "frame_shape") -> DataFrame:
    return frames.withColumn(out, frame_shape(F.col(payload)))


def boxes_on_frame(dets: DataFrame, shape: str = "frame_shape") -> DataFrame:
    """Boxes that were found on the fit-inside resized frame, on the frame
    itself; null where the shape is unknown."""
    h, w = F.get(F.col(shape), 0), F.get(F.col(shape), 1)
    iw, ih = fit_inside(w, h)
    moved = {"x1": (iw, w), "x2": (iw, w), "y1": (ih, h), "y2": (ih, h)}
    return dets.select(*[rescale(F.col(c), *moved[c]).alias(c) if c in moved else c for c in dets.columns])
