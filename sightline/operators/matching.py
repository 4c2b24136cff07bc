"""Frame/detection matching.

* ``frame_detection_join``: exact equi-join on the frame key (J2).
* ``asof_join``: each left row takes the latest right row at or before
  its time (J1), as a union + ``last(ignorenulls)`` window, split into
  time buckets so one hot key does not become one task.
* ``class_name_lookup``: a fixed, three-row dimension joined by
  broadcast (J3).
* ``time_gate_pairs``: same key, later row within a time horizon (J7),
  as an equi-join on a time bucket instead of a nested-loop theta join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Class id -> class name of the detector's label set used
# in the fixtures.
CLASS_NAMES = {0: "person", 1: "bag", 2: "bicycle"}


def frame_detection_join(frames: DataFrame, dets: DataFrame,
                         keys: Sequence[str] = ("frame_id", "camera_id"),
                         how: str = "inner") -> DataFrame:
    return frames.join(dets, list(keys), how)


def class_dim(spark: SparkSession, names: dict[int, str] | None = None) -> DataFrame:
    rows = sorted((names or CLASS_NAMES).items())
    return spark.createDataFrame(rows, "class_id int, class_name string")


def class_name_lookup(spark: SparkSession, df: DataFrame,
                      names: dict[int, str] | None = None) -> DataFrame:
    """Attach ``class_name``; the dimension is a fixed label set, so its
    broadcast size is bounded by the label count, not by the data. A class
    that the set does not have is named ``class_<id>``, a null one is null:
    no row is lost."""
    named = df.join(F.broadcast(class_dim(spark, names)), "class_id", "left")
    return named.withColumn("class_name", F.coalesce(
        "class_name", F.concat(F.lit("class_"), F.col("class_id").cast("string"))))


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], ts: str,
              right_cols: Sequence[str], tie: str | None = None,
              bucket: Column | None = None, prefix: str = "match_") -> DataFrame:
    """Latest-before match: for every left row the right row of the same
    ``by`` key with the greatest ``(ts, tie)`` such that ``ts <= left.ts``.

    Left rows without a match keep NULLs (left outer semantics). A NULL
    ``by`` or ``ts`` is never equal to or after anything: such left rows
    keep NULLs and such right rows match nothing. Within a
    bucket (default: the day of ``ts``) the match is a running
    ``last(ignorenulls)``; a left row whose bucket holds no earlier right
    row takes the last right row of the closest earlier bucket, found on a
    per-bucket summary table.
    """
    bucket = bucket if bucket is not None else F.date_trunc("day", F.col(ts))
    tie_cols = [tie] if tie else []
    payload = F.struct(*[F.col(c).alias(c) for c in [ts, *tie_cols, *right_cols]])
    lcols = left.columns
    known = F.lit(True)
    for c in [*by, ts]:
        known = known & F.col(c).isNotNull()
    outside = left.where(~known)
    left = left.where(known)
    rt = right.where(known).select(*by, F.col(ts), payload.alias("_sl_r")).withColumn("_sl_side", F.lit(0))
    lt = (left.withColumn("_sl_side", F.lit(1))
          .withColumn("_sl_r", F.lit(None).cast(rt.schema["_sl_r"].dataType)))
    u = lt.unionByName(rt, allowMissingColumns=True).withColumn("_sl_bk", bucket)
    order = [F.col(ts), F.col("_sl_side")] + ([F.col("_sl_r")[tie]] if tie else [])
    w = (Window.partitionBy(*by, "_sl_bk").orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = u.withColumn("_sl_m", F.last("_sl_r", ignorenulls=True).over(w))
    okey = F.when(F.col("_sl_side") == 0, F.struct(*[F.col("_sl_r")[c] for c in [ts, *tie_cols]]))
    edge = u.groupBy(*by, "_sl_bk").agg(F.max_by("_sl_r", okey).alias("_sl_e"))
    wb = (Window.partitionBy(*by).orderBy("_sl_bk")
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = edge.select(*by, "_sl_bk", F.last("_sl_e", ignorenulls=True).over(wb).alias("_sl_c"))
    lefts = inner.where(F.col("_sl_side") == 1)
    j = lefts.join(carry, [*by, "_sl_bk"], "inner")
    m = F.coalesce(F.col("_sl_m"), F.col("_sl_c"))
    matched = j.select(*lcols, *[m[c].alias(prefix + c) for c in [ts, *tie_cols, *right_cols]])
    if not any(f.nullable for f in left.schema.fields if f.name in {*by, ts}):
        return matched
    return matched.unionByName(outside, allowMissingColumns=True)


def time_gate_pairs(df: DataFrame, key: str, ts: str, horizon_s: int,
                    cols: Sequence[str]) -> DataFrame:
    """Pairs (a, b) of one key with ``0 < b.ts - a.ts <= horizon``.

    Time is cut into buckets of the horizon's width; ``b`` can only lie
    in ``a``'s bucket or the next one, so ``b`` is joined on both
    ``(key, bucket)`` and ``(key, bucket - 1)``. The pairs emitted are
    bounded by the horizon, never all pairs of a key.
    """
    sec = F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1_000_000)
    a = df.select(*[F.col(c).alias("a_" + c) for c in [key, ts, *cols]],
                  F.floor(sec / horizon_s).alias("_sl_bk"), sec.alias("_sl_as"))
    b = df.select(*[F.col(c).alias("b_" + c) for c in [key, ts, *cols]],
                  F.explode(F.array(F.floor(sec / horizon_s), F.floor(sec / horizon_s) - 1)).alias("_sl_bk"),
                  sec.alias("_sl_bs"))
    j = a.join(b, (F.col("a_" + key) == F.col("b_" + key)) & (a["_sl_bk"] == b["_sl_bk"]), "inner")
    dt = F.col("_sl_bs") - F.col("_sl_as")
    return (j.where((dt > 0) & (dt <= horizon_s))
            .withColumn("dt_s", dt)
            .drop("_sl_bk", "_sl_as", "_sl_bs", "b_" + key)
            .withColumnRenamed("a_" + key, key))
