"""Ordered-sequence helpers that stay parallel under skewed keys.

A window ``partitionBy(camera).orderBy(ts)`` puts every row of a camera
into one task; with 7 cameras (or one person holding a third of the
rows) that is one task for a third of the data. These helpers split the
sequence into ordered buckets (for example a day of ``ts``), run the
window per ``(key, bucket)``, and stitch the buckets together from a
small per-bucket summary: the classic two-level prefix sum.

The bucket expression must be monotone in the order columns. Rows whose key
or order column is null keep their place (a null is a value of its own, as
in a plain window): the stitch joins compare structs of the keys, in which
nulls are equal, so they stay plain equi-joins on the windows' partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BK = "_sl_bucket"
_PART = "_sl_part"      # struct of the key columns
_KEY = "_sl_bucket_key"        # struct of the key columns and the bucket


def _keyed(df: DataFrame, part: Sequence[str], bucket: Column) -> DataFrame:
    cols = [F.col(c) for c in part]
    return (df.withColumn(_BK, bucket)
            .withColumn(_PART, F.struct(*cols, F.lit(0).alias("_sl_one")))
            .withColumn(_KEY, F.struct(*cols, F.col(_BK))))


def _buckets(summary: DataFrame, part: Sequence[str]) -> DataFrame:
    """The per-bucket table with its key columns spelled out again."""
    return (summary.withColumn(_BK, F.col(_KEY)[_BK])
            .withColumn(_PART, F.struct(*[F.col(_KEY)[c].alias(c) for c in part], F.lit(0).alias("_sl_one"))))


def running_totals(df: DataFrame, part: Sequence[str], order: Sequence[str | Column],
                   bucket: Column, values: dict[str, Column | None]) -> DataFrame:
    """Several running sums over one ordering in one pass.

    ``values`` maps an output column to the summed expression (``None``
    counts rows, i.e. the running row number). One window over
    ``(part, bucket)``, one per-bucket aggregate and one join serve all
    outputs.
    """
    b = _keyed(df, part, bucket)
    tmp = {out: f"_sl_v{i}" for i, out in enumerate(values)}
    for out, v in values.items():
        b = b.withColumn(tmp[out], F.lit(1).cast("long") if v is None else v)
    inner_w = (Window.partitionBy(_KEY).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = b
    for out in values:
        inner = inner.withColumn(out, F.sum(tmp[out]).over(inner_w))
    # summarised from the windowed rows: already clustered by (part, bucket), no new shuffle
    per_bucket = _buckets(inner.groupBy(_KEY).agg(*[F.sum(tmp[o]).alias(tmp[o] + "t") for o in values]), part)
    prior_w = (Window.partitionBy(_PART).orderBy(_BK)
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_bucket.select(_KEY, *[
        F.coalesce(F.sum(tmp[o] + "t").over(prior_w), F.lit(0)).alias(tmp[o] + "o") for o in values])
    j = inner.join(offsets, _KEY, "inner")
    for out in values:
        j = j.withColumn(out, F.col(out) + F.col(tmp[out] + "o"))
    return j.drop(_BK, _PART, _KEY, *tmp.values(), *[t + "o" for t in tmp.values()])


def running_total(df: DataFrame, part: Sequence[str], order: Sequence[str | Column],
                  bucket: Column, value: Column | None, out: str) -> DataFrame:
    """``sum(value)`` over ``part`` ordered by ``order`` up to the current row.

    ``value=None`` counts rows, which is the running row number.
    """
    return running_totals(df, part, order, bucket, {out: value})


def with_neighbor(df: DataFrame, part: Sequence[str], order: Sequence[str],
                  bucket: Column, cols: Sequence[str], direction: str = "prev",
                  prefix: str | None = None) -> DataFrame:
    """Add the previous (or next) row's ``cols`` within ``part``.

    Within a bucket this is ``lag``/``lead``; across buckets the first
    (last) row of a bucket takes the last (first) row of the nearest
    non-empty bucket before (after) it, found on the per-bucket summary.
    """
    prefix = prefix or ("prev_" if direction == "prev" else "next_")
    b = _keyed(df, part, bucket)
    vals = F.struct(*[F.col(c) for c in cols])
    okey = F.struct(*[F.col(c) for c in order])
    w_in = Window.partitionBy(_KEY).orderBy(*order)
    wb = Window.partitionBy(_PART).orderBy(_BK)
    # the bucket's edge row; when only the order key itself is wanted a
    # plain min/max (hash aggregate) replaces min_by/max_by
    simple = len(order) == 1 and list(cols) == list(order)
    if direction == "prev":
        inner = b.withColumn("_sl_n", F.lag(vals).over(w_in))
        e = F.struct(F.max(order[0]).alias(order[0])) if simple else F.max_by(vals, okey)
        edge = _buckets(inner.groupBy(_KEY).agg(e.alias("_sl_e")), part)
        carry = edge.select(_KEY, F.lag("_sl_e").over(wb).alias("_sl_c"))
    else:
        inner = b.withColumn("_sl_n", F.lead(vals).over(w_in))
        e = F.struct(F.min(order[0]).alias(order[0])) if simple else F.min_by(vals, okey)
        edge = _buckets(inner.groupBy(_KEY).agg(e.alias("_sl_e")), part)
        carry = edge.select(_KEY, F.lead("_sl_e").over(wb).alias("_sl_c"))
    j = inner.join(carry, _KEY, "inner").withColumn(
        "_sl_n", F.coalesce(F.col("_sl_n"), F.col("_sl_c")))
    return j.select(*[c for c in df.columns],
                    *[F.col("_sl_n")[c].alias(prefix + c) for c in cols])


def numbered_runs(df: DataFrame, part: Sequence[str], order: Sequence[str], bucket: Column,
                  cols: Sequence[str], breaks, out: str) -> DataFrame:
    """Gaps-and-islands numbering in one window pass per bucket.

    ``breaks(prev, cur)`` gets two structs of ``cols`` (the previous and the
    current row) and returns true where a new run starts; the first row of
    each ``part`` always starts run 1. Within a bucket, breaks between
    consecutive rows are counted by a running sum; the bucket summary
    (first row, last row, number of inner breaks) decides whether a
    bucket's first row breaks and how many runs came before it. One
    summary, one small window over buckets and one join back serve both
    the previous-row lookup and the numbering.
    """
    b = _keyed(df, part, bucket)
    cur = F.struct(*[F.col(c).alias(c) for c in cols])
    okey = F.struct(*[F.col(c) for c in order])
    w_in = Window.partitionBy(_KEY).orderBy(*order)
    x = b.withColumn("_sl_prev", F.lag(cur).over(w_in))
    x = x.withColumn("_sl_ib", F.when(F.col("_sl_prev").isNull(), F.lit(0))
                     .otherwise(breaks(F.col("_sl_prev"), cur).cast("long")))
    x = x.withColumn("_sl_run", F.sum("_sl_ib").over(
        w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    summ = _buckets(x.groupBy(_KEY).agg(F.min_by(cur, okey).alias("_sl_first"),
                                        F.max_by(cur, okey).alias("_sl_last"),
                                        F.sum("_sl_ib").alias("_sl_sib")), part)
    wb = Window.partitionBy(_PART).orderBy(_BK)
    summ = summ.withColumn("_sl_pl", F.lag("_sl_last").over(wb))
    summ = summ.withColumn("_sl_fb", F.when(F.col("_sl_pl").isNull(), F.lit(1))
                           .otherwise(breaks(F.col("_sl_pl"), F.col("_sl_first")).cast("long")))
    summ = summ.withColumn("_sl_off", F.coalesce(F.sum(F.col("_sl_fb") + F.col("_sl_sib")).over(
        wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = x.join(summ.select(_KEY, "_sl_off", "_sl_fb"), _KEY, "inner")
    return (j.withColumn(out, (F.col("_sl_off") + F.col("_sl_fb") + F.col("_sl_run")).cast("long"))
            .drop(_BK, _PART, _KEY, "_sl_prev", "_sl_ib", "_sl_run", "_sl_off", "_sl_fb"))
