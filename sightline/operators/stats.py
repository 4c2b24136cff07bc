"""Throughput, latency and buffer statistics.

Counters a stream consumer keeps by hand become aggregates: partial
aggregation runs map-side, so even a camera holding a third of all rows
shuffles one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.operators.sequence import running_totals


def per_frame_counts(frames: DataFrame, dets: DataFrame, keys: Sequence[str] = ("frame_id",),
                     out: str = "detection_count") -> DataFrame:
    """A1 + J8: detections per frame, frames without detections kept as 0.

    Detections are reduced to one row per frame before the join, so the
    join moves counts, not boxes.
    """
    counts = dets.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return (frames.join(counts, list(keys), "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("long")))


def empty_frames(frames: DataFrame, dets: DataFrame, keys: Sequence[str] = ("frame_id",)) -> DataFrame:
    """Frames that carry no detection (anti join on the frame key).

    The boxes are reduced to distinct frame keys first (a map-side partial
    aggregate), so a frame with very many boxes ships one row per task."""
    return frames.join(dets.select(*keys).distinct(), list(keys), "left_anti")


def stream_totals(frames: DataFrame, dets: DataFrame) -> DataFrame:
    """A2: total frames and detections in one global aggregate (no join)."""
    tagged = (frames.select(F.lit(1).alias("_f"), F.lit(0).alias("_d"))
              .unionByName(dets.select(F.lit(0).alias("_f"), F.lit(1).alias("_d"))))
    return tagged.agg(F.sum("_f").cast("long").alias("total_frames"),
                      F.sum("_d").cast("long").alias("total_detections"))


def elapsed_seconds(t0: Column, t1: Column) -> Column:
    """Elapsed time in seconds as double, microsecond precision."""
    return (F.unix_micros(t1.cast("timestamp")) - F.unix_micros(t0.cast("timestamp"))) / F.lit(1e6)


def guarded_rate(n: Column, elapsed: Column) -> Column:
    """A3: n / elapsed, 0 when elapsed is not positive."""
    return F.when(elapsed > 0, n / elapsed).otherwise(F.lit(0.0))


def overall_rate(frames: DataFrame, ts: str = "ts") -> DataFrame:
    agg = frames.agg(F.count(F.lit(1)).alias("n_frames"),
                     F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    el = elapsed_seconds(F.col("first_ts"), F.col("last_ts"))
    return agg.select("n_frames", "first_ts", "last_ts", el.alias("elapsed_s"),
                      guarded_rate(F.col("n_frames"), el).alias("frames_per_s"))


def tumbling_rate(df: DataFrame, ts: str, width: str, width_seconds: float,
                  keys: Sequence[str] = ()) -> DataFrame:
    """A4(a): aligned event-time windows, count and rate per window."""
    g = df.groupBy(*keys, F.window(ts, width).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n", (F.col("n") / F.lit(float(width_seconds))).alias("rate_per_s"))


def flushed_totals(windows: DataFrame, keys: Sequence[str] = (), start: str = "window_start",
                   n: str = "n") -> DataFrame:
    """A5: cumulative counter that only includes closed windows.

    The last window of each key is still open (a counter flushes only
    when the next period starts), so it is dropped. The running sum is split
    by day, so a key's whole history is not one task.
    """
    out = running_totals(windows, list(keys), [start], F.date_trunc("day", F.col(start)), {"cum_n": F.col(n)})
    last = windows.groupBy(*keys).agg(F.max(start).alias("_last")) if keys else windows.agg(F.max(start).alias("_last"))
    match = F.col("_last") > F.col(start)
    for k in keys:
        last = last.withColumnRenamed(k, "_last_" + k)
        match = match & F.col(k).eqNullSafe(F.col("_last_" + k))
    return out.join(last, match, "left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   cols: Sequence[str]) -> DataFrame:
    """The newest row per key as a ``max_by`` aggregate.

    ``max_by`` is a partial aggregate, so a hot key costs one row per
    task in the shuffle instead of all its rows.
    """
    okey = F.struct(*[F.col(c) for c in order])
    vals = F.struct(*[F.col(c) for c in cols])
    g = df.groupBy(*keys).agg(F.max_by(vals, okey).alias("_v"))
    return g.select(*keys, *[F.col("_v")[c].alias(c) for c in cols])


def keep_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
           rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per key by ``order``.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit
    before the shuffle, so each task sends at most n rows per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    if rank_col:
        return out.withColumn(rank_col, F.col("_rn").cast("long")).drop("_rn")
    return out.drop("_rn")


def running_frame_stats(frames_with_counts: DataFrame, part: Sequence[str],
                        order: Sequence[str], bucket: Column,
                        count_col: str = "detection_count") -> DataFrame:
    """Running frame number and running detection total per feed."""
    return running_totals(frames_with_counts, part, order, bucket,
                          {"frame_no": None, "running_detections": F.col(count_col)})


def running_rate(running: DataFrame, part: Sequence[str], ts: str, n: str = "frame_no",
                 out: str = "running_fps") -> DataFrame:
    """The rate so far next to a running count: rows of the feed up to
    this one over the seconds since its first. NULL while no time has
    passed. The first times come from a partial aggregate, one row a feed."""
    first = running.groupBy(*[F.col(p).alias("_f_" + p) for p in part]).agg(F.min(ts).alias("_first"))
    same = F.lit(True)
    for p in part:
        same = same & F.col(p).eqNullSafe(F.col("_f_" + p))
    el = elapsed_seconds(F.col("_first"), F.col(ts))
    return (running.join(first, same).withColumn(out, F.when(el > 0, F.col(n) / el))
            .drop("_first", *["_f_" + p for p in part]))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      ps: dict[str, float]) -> DataFrame:
    """Exact percentiles (linear interpolation between closest ranks) per
    key, several in one pass, without gathering a key's values in one task.

    Rows are counted per (key, value) before they move. The distinct values
    are cut into ordered buckets by range of value, and a value's first rank
    is the running sum of the counts (``running_totals``: per bucket, then
    stitched), so a key with a third of all rows is spread over its buckets
    and nothing depends on which partition a row is in. A value that holds a
    target rank gives it. A NULL key is a key of its own.
    """
    s = (df.select(*keys, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
         .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    # buckets of about 0.1 % of the value: monotone, the same for any data
    v = F.col("_v").cast("double")
    size = F.when(F.isnan(v), F.lit(1e9)).otherwise(F.floor(F.log2(F.abs(v) + 1) * 512) * F.signum(v))
    upto = running_totals(s, list(keys), ["_v"], size, {"_upto": F.col("_c")})
    total = s.groupBy(*[F.col(k).alias("_t_" + k) for k in keys]).agg(F.sum("_c").alias("_n"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_t_" + k))
    ranked = upto.join(total, same).withColumn("_first", F.col("_upto") - F.col("_c"))
    pos = {name: F.lit(float(p)) * (F.col("_n") - 1) for name, p in ps.items()}
    wanted = None
    for q in pos.values():
        hit = _holds(F.floor(q)) | _holds(F.ceil(q))
        wanted = hit if wanted is None else wanted | hit
    aggs = []
    for name, q in pos.items():
        aggs += [F.max(F.when(_holds(F.floor(q)), F.col("_v"))).alias(f"_{name}_lo"),
                 F.max(F.when(_holds(F.ceil(q)), F.col("_v"))).alias(f"_{name}_hi"),
                 F.first(q - F.floor(q)).alias(f"_{name}_f")]
    g = ranked.where(wanted).groupBy(*keys).agg(*aggs)
    return g.select(*keys, *[(F.col(f"_{n}_lo") + F.col(f"_{n}_f") * (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")))
                             .alias(n) for n in ps])


def _holds(rank: Column) -> Column:
    return (F.col("_first") <= rank) & (rank < F.col("_upto"))


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, p: float,
                     out: str = "pct") -> DataFrame:
    """One exact percentile per key (see ``exact_percentiles``)."""
    return exact_percentiles(df, keys, value, {out: p})


def latency_summary(df: DataFrame, node: Column, value: str) -> DataFrame:
    """Per-node count, average, maximum, exact median and 95th percentile.

    The mean and maximum are partial aggregates; both percentiles come from
    one ``exact_percentiles`` pass, so a busy node is not one task."""
    d = df.withColumn("node", node)
    basic = d.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("avg_ms"),
                                  F.max(value).alias("max_ms"))
    pct = exact_percentiles(d, ["node"], value, {"p50_ms": 0.5, "p95_ms": 0.95})
    pct = pct.withColumnRenamed("node", "_node")
    return basic.join(pct, F.col("node").eqNullSafe(F.col("_node")), "left").drop("_node")
