"""Detection predicates (F1-F7) as DataFrame transforms.

One ``DetectionPolicy`` replaces the three different confidence rules a
detector deployment tends to accumulate; it is applied as plain column
predicates so Catalyst can push it into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: COCO class id of a person.
PERSON_CLASS = 0


@dataclass(frozen=True)
class DetectionPolicy:
    threshold: float = 0.5              # inclusive: confidence >= threshold
    classes: tuple[int, ...] | None = None   # None keeps every class

    def predicate(self, confidence: str = "confidence", class_id: str = "class_id") -> Column:
        p = F.col(confidence) >= F.lit(self.threshold)
        if self.classes is not None:
            p = p & F.col(class_id).isin(list(self.classes))
        return p

    def element_predicate(self, d: Column) -> Column:
        """The same rule on one element of a nested ``detections`` array."""
        p = d["confidence"] >= F.lit(self.threshold)
        if self.classes is not None:
            p = p & d["class_id"].isin(list(self.classes))
        return p


def confidence_filter(dets: DataFrame, threshold: float = 0.5) -> DataFrame:
    return dets.where(DetectionPolicy(threshold).predicate())


def class_filter(dets: DataFrame, classes=(PERSON_CLASS,), threshold: float = 0.5) -> DataFrame:
    return dets.where(DetectionPolicy(threshold, tuple(classes)).predicate())


def filter_nested(messages: DataFrame, policy: DetectionPolicy,
                  col: str = "detections") -> DataFrame:
    """Apply a policy inside a nested detections array (message form)."""
    return messages.withColumn(col, F.filter(F.col(col), policy.element_predicate))


def nonempty(messages: DataFrame, col: str = "detections") -> DataFrame:
    """Keep messages that carry at least one detection."""
    return messages.where(F.size(F.coalesce(F.col(col), F.array())) > 0)


def every_nth(df: DataFrame, n: int, seq_col: str) -> DataFrame:
    """keep rows whose 1-based running number is a multiple of n."""
    return df.where(F.pmod(F.col(seq_col), F.lit(n)) == 0)


def jpeg_payload(payload: Column) -> Column:
    """true when the bytes start with the JPEG start-of-image marker."""
    return F.coalesce(F.substring(payload, 1, 2) == F.unhex(F.lit("FFD8")), F.lit(False))


def split_errors(scored: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, error rows) of a scored stream; both keep flowing."""
    return scored.where(F.col(error_col).isNull()), scored.where(F.col(error_col).isNotNull())
