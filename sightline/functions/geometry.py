"""Box and ground-plane geometry as column expressions.

All of these are built-in arithmetic, so they stay inside whole-stage
code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Detector input limit (fit-inside resize).
MAX_W = 640
MAX_H = 480

# Ground-plane grid of the multi-camera dataset: 480 x 1440
# positions, 2.5 cm apart, origin at (-3.0 m, -9.0 m).
GRID_W = 480
GRID_H = 1440
GRID_STEP_M = 0.025
GRID_X0_M = -3.0
GRID_Y0_M = -9.0


def area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.greatest(x2 - x1, F.lit(0.0)) * F.greatest(y2 - y1, F.lit(0.0))


def intersection(a: tuple[Column, Column, Column, Column],
                 b: tuple[Column, Column, Column, Column]) -> Column:
    iw = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    ih = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(iw, F.lit(0.0)) * F.greatest(ih, F.lit(0.0))


def iou(a: tuple[Column, Column, Column, Column],
        b: tuple[Column, Column, Column, Column]) -> Column:
    """Intersection over union; 0 for disjoint or zero-area boxes and
    for boxes with a null, NaN or infinite corner (NaN is above every number,
    so it fails the second test)."""
    inter = intersection(a, b)
    union = area(*a) + area(*b) - inter
    return F.when((union > 0) & (union < float("inf")), inter / union).otherwise(F.lit(0.0))


def is_box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Finite corners, and some area between them."""
    finite = F.lit(True)
    for c in (x1, y1, x2, y2):
        finite = finite & (F.abs(c) < float("inf"))
    return F.coalesce(finite & (x2 > x1) & (y2 > y1), F.lit(False))


def box(prefix: str = "") -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(prefix + c) for c in ("x1", "y1", "x2", "y2"))


def fit_inside(w: Column, h: Column, max_w: int = MAX_W, max_h: int = MAX_H) -> tuple[Column, Column]:
    """Resize only when larger than the limit, keep the aspect ratio,
    truncate to whole pixels."""
    scale = F.least(F.lit(float(max_w)) / w, F.lit(float(max_h)) / h)
    big = (w > max_w) | (h > max_h)
    return (F.when(big, (w * scale).cast("int")).otherwise(w.cast("int")),
            F.when(big, (h * scale).cast("int")).otherwise(h.cast("int")))


def rescale(v: Column, src: Column, dst: Column) -> Column:
    """A coordinate from a src-sized image to a dst-sized image."""
    return v * (dst.cast("double") / src.cast("double"))


def truncate_int(v: Column) -> Column:
    """T4: pixel value toward zero, as ``int(x)`` does."""
    return v.cast("int")


# Fixed value: gap in pixels between a box edge and its label.
LABEL_GAP = 10


def label_row(y1: Column, text_h: int = 20) -> Column:
    """Label above the box when there is room, else below its top."""
    return F.when(y1 - LABEL_GAP > LABEL_GAP, y1 - LABEL_GAP).otherwise(y1 + text_h + LABEL_GAP)


def ground_x(position_id: Column) -> Column:
    """Metres east of the grid origin."""
    return F.lit(GRID_X0_M) + F.lit(GRID_STEP_M) * F.pmod(position_id, F.lit(GRID_W))


def ground_y(position_id: Column) -> Column:
    """Metres north of the grid origin."""
    return F.lit(GRID_Y0_M) + F.lit(GRID_STEP_M) * F.floor(position_id / F.lit(GRID_W))
