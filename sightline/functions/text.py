"""Display and report text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output formats that consumers of the detection stream
# already parse (label text, report line, numbered file stem, clock, node tag).
LABEL_FORMAT = "%s: %.{places}f"
REPORT_FORMAT = "  Person %d: bbox=(%.0f,%.0f,%.0f,%.0f), conf=%.3f"
FILE_FORMAT = "{stem}_%06d.{ext}"
FILE_STEM = "annotated_frame"
CLOCK_FORMAT = "HH:mm:ss"
NODE_PREFIX = "spark-worker-"


def label_text(class_name: Column, confidence: Column, places: int = 2) -> Column:
    """T5: ``"person: 0.87"``."""
    return F.format_string(LABEL_FORMAT.format(places=places), class_name, confidence)


def report_line(n: Column, x1: Column, y1: Column, x2: Column, y2: Column, conf: Column) -> Column:
    """One line of the per-frame detection report (1-based ``n``)."""
    return F.format_string(REPORT_FORMAT, n, x1, y1, x2, y2, conf)


def file_name(seq: Column, stem: str = FILE_STEM, ext: str = "jpg") -> Column:
    """Zero-padded numbered result file name."""
    return F.format_string(FILE_FORMAT.format(stem=stem, ext=ext), seq)


def clock(ts: Column) -> Column:
    """Wall-clock text."""
    return F.date_format(ts, CLOCK_FORMAT)


def round2(v: Column) -> Column:
    """Two decimals, half away from zero."""
    return F.round(v, 2)
