"""Crowd analytics over sightings.

Sequence steps per person (previous camera, stays, legs) use the
bucketed helpers of ``sequence`` so a person seen in a third of all rows
is still spread over many tasks; counts are partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.geometry import GRID_W, ground_x, ground_y
from sightline.operators.sequence import numbered_runs, running_total, with_neighbor
from sightline.operators.stats import elapsed_seconds


def day_bucket(ts: str = "ts") -> Column:
    return F.date_trunc("day", F.col(ts))


def ground_positions(s: DataFrame, pos: str = "position_id") -> DataFrame:
    return s.withColumn("x_m", ground_x(F.col(pos))).withColumn("y_m", ground_y(F.col(pos)))


def heatmap(s: DataFrame, cell: int = 40, pos: str = "position_id", who: str = "global_id") -> DataFrame:
    """Sightings and distinct people per ground cell of ``cell`` positions."""
    cx = F.floor(F.pmod(F.col(pos), F.lit(GRID_W)) / cell)
    cy = F.floor(F.floor(F.col(pos) / F.lit(GRID_W)) / cell)
    return (s.groupBy(cx.alias("cell_x"), cy.alias("cell_y"))
            .agg(F.count(F.lit(1)).alias("n_sightings"), F.countDistinct(who).alias("n_people")))


def people_per_window(s: DataFrame, width: str = "1 hour", who: str = "global_id",
                      exact: bool = True) -> DataFrame:
    """A10: people per camera and window (exact or HyperLogLog++)."""
    distinct = F.countDistinct(who) if exact else F.approx_count_distinct(who)
    g = s.groupBy("camera_id", F.window("ts", width).alias("w")).agg(
        distinct.alias("n_people"), F.count(F.lit(1)).alias("n_sightings"))
    return g.select("camera_id", F.col("w.start").alias("window_start"), "n_people", "n_sightings")


def alerts(counts: DataFrame, key: str, n: str, k: float = 2.0) -> DataFrame:
    """Windows whose count reaches mean + k * stddev of their key.

    The per-key statistics table has one row per key, so the join back
    is a broadcast of a table bounded by the number of cameras."""
    st = counts.groupBy(key).agg(F.avg(n).alias("_mu"), F.stddev_samp(n).alias("_sd"))
    thr = F.col("_mu") + F.lit(k) * F.col("_sd")
    return (counts.join(st, key).where(F.col(n) >= thr)
            .withColumn("threshold", thr).drop("_mu", "_sd"))


def moves(s: DataFrame, who: str = "global_id", order: Sequence[str] = ("ts", "event_id"),
          bucket: Column | None = None) -> DataFrame:
    """Each sighting with the previous camera of the same person."""
    bucket = bucket if bucket is not None else day_bucket(order[0])
    return with_neighbor(s, [who], list(order), bucket, ["camera_id", *order], "prev")


def next_steps(s: DataFrame, who: str = "global_id", order: Sequence[str] = ("ts", "event_id"),
               cols: Sequence[str] = ("event_id", "camera_id", "ts", "position_id")) -> DataFrame:
    """Each sighting with the same person's next sighting (``next_*``)."""
    return with_neighbor(s, [who], list(order), day_bucket(order[0]), list(cols), "next")


def flow_edges(s: DataFrame, who: str = "global_id") -> DataFrame:
    """Camera -> camera transitions of people, counted."""
    m = moves(s, who)
    return (m.where(F.col("prev_camera_id").isNotNull() & (F.col("prev_camera_id") != F.col("camera_id")))
            .groupBy(F.col("prev_camera_id").alias("src"), F.col("camera_id").alias("dst"))
            .agg(F.count(F.lit(1)).alias("n_moves")))


def islands(s: DataFrame, who: str = "global_id", order: Sequence[str] = ("ts", "event_id"),
            max_gap_s: float | None = None, out: str = "stay_no") -> DataFrame:
    """Number consecutive runs of one camera per person (gaps-and-islands).

    A run breaks when the camera changes or, with ``max_gap_s``, when the
    person was unseen for longer than that.
    """
    ts = order[0]

    def breaks(prev, cur):
        b = prev["camera_id"] != cur["camera_id"]
        if max_gap_s is not None:
            b = b | (elapsed_seconds(prev[ts], cur[ts]) > max_gap_s)
        return b
    return numbered_runs(s, [who], list(order), day_bucket(ts), ["camera_id", ts], breaks, out)


def stays(s: DataFrame, who: str = "global_id", max_gap_s: float | None = 86400.0,
          out: str = "stay_no") -> DataFrame:
    """Stays (runs) with start, end, size and dwell seconds."""
    isl = islands(s, who, max_gap_s=max_gap_s, out=out)
    g = isl.groupBy(who, out, "camera_id").agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("n_sightings"))
    return g.withColumn("dwell_s", elapsed_seconds(F.col("start_ts"), F.col("end_ts")))


def sessions(s: DataFrame, who: str = "global_id", gap_s: float = 1800.0,
             order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """R5 (batch twin): activity sessions per person, as ``session_window``
    defines them: a sighting opens a new session when it comes ``gap_s`` or
    more after the previous one; a session ends ``gap_s`` after its last
    sighting. Built on the bucketed run numbering, so a very active person
    is not one task (``session_window`` clusters all of a key's rows in one
    task).
    """
    ts = order[0]
    numbered = numbered_runs(s, [who], list(order), day_bucket(ts), [ts],
                             lambda p, c: elapsed_seconds(p[ts], c[ts]) >= gap_s, "session_no")
    g = numbered.groupBy(who, "session_no").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("_last"),
        F.count(F.lit(1)).alias("n_sightings"))
    return g.select(who, "session_no", "session_start",
                    (F.col("_last") + F.make_dt_interval(secs=F.lit(float(gap_s)))).alias("session_end"),
                    "n_sightings")


def routes(legs: DataFrame, who: str, leg: str, hops: int = 3, sep: str = ">") -> DataFrame:
    """Consecutive ``hops``-leg camera routes per person.

    ``leg`` is a dense per-person leg number. Each leg is copied to the
    ``hops`` routes it can belong to (route start = leg - k, position k),
    and one aggregation per (person, route start) assembles the route: a
    group never holds more than ``hops`` rows, and no join or per-person
    window is needed.
    """
    e = legs.select(who, F.col(leg).alias("_l"), "camera_id",
                    F.explode(F.sequence(F.lit(0), F.lit(hops - 1))).alias("_k"))
    g = (e.withColumn("_start", F.col("_l") - F.col("_k"))
         .groupBy(who, "_start")
         .agg(F.count(F.lit(1)).alias("_n"),
              *[F.max(F.when(F.col("_k") == k, F.col("camera_id"))).alias(f"_c{k}") for k in range(hops)]))
    full = g.where((F.col("_n") == hops) & (F.col("_start") >= 1))
    return full.select(who, F.col("_start").alias("first_leg"),
                       F.concat_ws(sep, *[F.col(f"_c{k}") for k in range(hops)]).alias("route"))


def two_hop(edges: DataFrame, src: str = "src", dst: str = "dst", w: str = "n_moves") -> DataFrame:
    """A -> b -> c paths over the camera graph, weight = weaker hop."""
    a = edges.select(F.col(src).alias("src"), F.col(dst).alias("mid"), F.col(w).alias("w1"))
    b = edges.select(F.col(src).alias("mid"), F.col(dst).alias("dst"), F.col(w).alias("w2"))
    j = a.join(b, "mid").where(F.col("src") != F.col("dst"))
    return j.select("src", "mid", "dst", F.least("w1", "w2").alias("weight"))


def occupancy_peak(s: DataFrame, key: str = "camera_id", ts: str = "ts", stay: str = "1 hour",
                   tie: str = "event_id") -> DataFrame:
    """Peak simultaneous presence per key by a sweep line.

    Every sighting is present from ``ts`` for ``stay``: +1 at start, -1 at
    end; at equal times ends count before starts. The running sum is the
    bucketed two-level prefix sum, so a busy camera is not one task.
    """
    starts = s.select(key, F.col(ts).alias("t"), F.lit(1).alias("delta"), F.col(tie).alias("tie"))
    ends = s.select(key, (F.col(ts) + F.expr(f"INTERVAL {stay}")).alias("t"), F.lit(-1).alias("delta"),
                    F.col(tie).alias("tie"))
    ev = starts.unionByName(ends)
    run = running_total(ev, [key], ["t", "delta", "tie"], F.date_trunc("day", "t"),
                        F.col("delta").cast("long"), "occupancy")
    return run.groupBy(key).agg(F.max("occupancy").alias("peak"),
                                F.min_by("t", F.struct(-F.col("occupancy"), F.col("t"))).alias("peak_ts"))


def pseudonymise(s: DataFrame, who: str = "global_id", salt: str = "salt",
                 cell_m: float = 1.0) -> DataFrame:
    """Salted SHA-256 of the identity and place coarsened to cells."""
    return s.select(
        "event_id",
        F.sha2(F.concat(F.lit(salt), F.col(who)), 256).alias("pseudo_id"),
        "camera_id",
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        F.floor(ground_x(F.col("position_id")) / cell_m).cast("long").alias("cell_x"),
        F.floor(ground_y(F.col("position_id")) / cell_m).cast("long").alias("cell_y"),
    )
