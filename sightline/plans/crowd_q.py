"""Queries over sightings: ground plane, crowd counts, flow, stays, routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.functions.geometry import ground_x, ground_y
from sightline.operators import crowd, paths, sketches, stats
from sightline.operators.sequence import numbered_runs
from sightline.operators.stats import elapsed_seconds, keep_n
from sightline.plans.registry import query
from sightline.plans.sql_views import S_
from sightline.session import materialize
from sightline.sources.tables import EVENT_CAMERA, OTHER_CAMERA, sightings

_X = "(-3.0 + 0.025 * (position_id % 480))"
_Y = "(-9.0 + 0.025 * floor(position_id / 480))"


@query("ground_position", S_ + f"""
SELECT event_id, position_id, round(CAST({_X} AS DOUBLE), 3) AS x_m, round(CAST({_Y} AS DOUBLE), 3) AS y_m FROM sightings""")
def ground_position(spark, sf):
    s = crowd.ground_positions(sightings(spark, sf).select("event_id", "position_id"))
    return s.select("event_id", "position_id", F.round("x_m", 3).alias("x_m"), F.round("y_m", 3).alias("y_m"))


@query("ground_heatmap", S_ + """
SELECT CAST(floor((position_id % 480) / 40) AS BIGINT) AS cell_x,
       CAST(floor(floor(position_id / 480) / 40) AS BIGINT) AS cell_y,
       CAST(count(*) AS BIGINT) AS n_sightings, CAST(count(DISTINCT global_id) AS BIGINT) AS n_people
FROM sightings GROUP BY 1, 2""")
def ground_heatmap(spark, sf):
    return crowd.heatmap(sightings(spark, sf).select("global_id", "position_id"), 40)


_HOURLY = S_ + """, hourly AS (
  SELECT camera_id, time_bucket(INTERVAL 1 HOUR, ts) AS hour,
         CAST(count(DISTINCT global_id) AS BIGINT) AS n_people, CAST(count(*) AS BIGINT) AS n_sightings
  FROM sightings GROUP BY 1, 2)
"""


def _hourly(spark, sf):
    s = sightings(spark, sf).select("camera_id", "ts", "global_id")
    return crowd.people_per_window(s, "1 hour").withColumnRenamed("window_start", "hour")


@query("people_per_camera_hour", _HOURLY + "SELECT camera_id, hour, n_people, n_sightings FROM hourly")
def people_per_camera_hour(spark, sf):
    return _hourly(spark, sf)


@query("crowd_alerts", _HOURLY + """
, st AS (SELECT camera_id, avg(n_sightings) AS mu, stddev_samp(n_sightings) AS sd FROM hourly GROUP BY 1)
SELECT h.camera_id, h.hour, h.n_sightings, round(st.mu + 2 * st.sd, 6) AS threshold
FROM hourly h JOIN st ON h.camera_id = st.camera_id WHERE h.n_sightings >= st.mu + 2 * st.sd""")
def crowd_alerts(spark, sf):
    a = crowd.alerts(_hourly(spark, sf).select("camera_id", "hour", "n_sightings"), "camera_id", "n_sightings")
    return a.withColumn("threshold", F.round("threshold", 6))


_MOVES = S_ + """, moves AS (
  SELECT *, lag(camera_id) OVER w AS prev_camera_id, lag(ts) OVER w AS prev_ts
  FROM sightings WINDOW w AS (PARTITION BY global_id ORDER BY ts, event_id)),
edges AS (SELECT prev_camera_id AS src, camera_id AS dst, CAST(count(*) AS BIGINT) AS n_moves
          FROM moves WHERE prev_camera_id IS NOT NULL AND prev_camera_id <> camera_id GROUP BY 1, 2)
"""


def _edges(spark, sf):
    return crowd.flow_edges(sightings(spark, sf).select("event_id", "global_id", "camera_id", "ts"))


@query("flow_matrix", _MOVES + "SELECT src, dst, n_moves FROM edges")
def flow_matrix(spark, sf):
    return _edges(spark, sf)


CAMERAS = sorted(set(EVENT_CAMERA.values()) | {OTHER_CAMERA})


@query("flow_pivot", _MOVES + "SELECT src, " + ", ".join(
    f"CAST(coalesce(sum(n_moves) FILTER (WHERE dst = '{c}'), 0) AS BIGINT) AS {c}" for c in CAMERAS)
    + ", CAST(coalesce(sum(n_moves) FILTER (WHERE dst NOT IN (" + ", ".join(f"'{c}'" for c in CAMERAS)
    + ")), 0) AS BIGINT) AS other FROM edges GROUP BY src")
def flow_pivot(spark, sf):
    """The flow matrix as one row per source camera. The pivot values
    are given, so Spark does not run a job to discover them; moves to any
    other camera are counted as ``other``."""
    names = [*CAMERAS, "other"]
    dst = F.when(F.col("dst").isin(CAMERAS), F.col("dst")).otherwise(F.lit("other"))
    p = _edges(spark, sf).withColumn("dst", dst).groupBy("src").pivot("dst", names).agg(F.sum("n_moves"))
    return p.select("src", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in names])


@query("two_hop_paths", _MOVES + """
SELECT a.src, a.dst AS mid, b.dst, least(a.n_moves, b.n_moves) AS weight
FROM edges a JOIN edges b ON a.dst = b.src WHERE a.src <> b.dst""")
def two_hop_paths(spark, sf):
    return crowd.two_hop(_edges(spark, sf))


# Fixed parameters (our choice): zones of 96 x 96 ground positions; a leg is
# two sightings of a person less than a week apart.
ZONE, LEG_S = 96, 7 * 86400

_LEGS = S_ + f"""
, z AS (SELECT global_id, ts, event_id, CAST(floor((position_id % 480) / {ZONE}) AS BIGINT) * 100
               + CAST(floor(floor(position_id / 480) / {ZONE}) AS BIGINT) AS zone FROM sightings),
n AS (SELECT zone AS src, lead(zone) OVER w AS dst, (epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1e6 AS seconds
      FROM z WINDOW w AS (PARTITION BY global_id ORDER BY ts, event_id)),
legs AS (SELECT src, dst, min(seconds) AS seconds FROM n WHERE src <> dst AND seconds < {LEG_S} GROUP BY src, dst
         QUALIFY row_number() OVER (PARTITION BY src ORDER BY min(seconds), dst) <= 4)
"""


@query("zone_reachability", "WITH RECURSIVE " + _LEGS[len("WITH "):] + """
, hop(src, dst, hops) USING KEY (src, dst) AS (
  SELECT src, dst, 1 FROM legs
  UNION
  SELECT h.src, l.dst, min(h.hops + 1) FROM hop h JOIN legs l ON h.dst = l.src
  LEFT JOIN recurring.hop k ON k.src = h.src AND k.dst = l.dst
  WHERE h.src <> l.dst AND (k.hops IS NULL OR h.hops + 1 < k.hops) GROUP BY h.src, l.dst),
fast(src, dst, seconds) USING KEY (src, dst) AS (
  SELECT src, dst, seconds FROM legs
  UNION
  SELECT h.src, l.dst, min(h.seconds + l.seconds) FROM fast h JOIN legs l ON h.dst = l.src
  LEFT JOIN recurring.fast k ON k.src = h.src AND k.dst = l.dst
  WHERE h.src <> l.dst AND (k.seconds IS NULL OR h.seconds + l.seconds < k.seconds) GROUP BY h.src, l.dst)
SELECT src, dst, CAST(hops AS BIGINT) AS hops, CAST(round(seconds * 1e6) AS BIGINT) AS micros FROM hop JOIN fast USING (src, dst)""")
def zone_reachability(spark, sf):
    """From which ground zone people get to which others along the four
    fastest legs out of each zone, in how few legs, and how fast."""
    s = sightings(spark, sf)
    zone = (F.floor(F.pmod("position_id", F.lit(480)) / ZONE) * 100
            + F.floor(F.floor(F.col("position_id") / 480) / ZONE)).cast("long")
    s = s.select("global_id", "event_id", "ts", zone.alias("zone"))
    nxt = crowd.next_steps(s, cols=("zone", "ts"))
    legs = nxt.select(F.col("zone").alias("src"), F.col("next_zone").alias("dst"),
                      elapsed_seconds(F.col("ts"), F.col("next_ts")).alias("seconds"))
    legs = legs.where((F.col("src") != F.col("dst")) & (F.col("seconds") < LEG_S)).groupBy("src", "dst").agg(
        F.min("seconds").alias("seconds"))
    legs = keep_n(legs, ["src"], [F.col("seconds"), F.col("dst")], 4, "place")
    r = paths.reachability(legs.select("src", "dst", "seconds"))
    return r.select("src", "dst", "hops", F.round(F.col("seconds") * 1e6).cast("long").alias("micros"))


@query("sketched_days", S_ + """
SELECT camera_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, CAST(count(*) AS BIGINT) AS n,
       CAST(count(DISTINCT global_id) AS BIGINT) AS n_people, true AS people_within, true AS median_within, true AS p95_within
FROM sightings GROUP BY 1, 2""")
def sketched_days(spark, sf):
    """A8/A10 from stored sketches: hours are united into days; the answers
    are held against the exact ones, which must be within the stated bounds."""
    s = sightings(spark, sf).select("camera_id", "ts", "global_id", "confidence")
    hours = materialize(sketches.hourly_sketches(s, ["camera_id"], F.col("global_id"), F.col("confidence")), "sketches")
    day = F.date_trunc("day", "hour").cast("timestamp_ntz").alias("day")
    d = sketches.unite(hours, ["camera_id", day]).select(
        "camera_id", "day", "n", sketches.n_distinct().alias("about"),
        sketches.quantile(0.5).alias("median"), sketches.quantile(0.95).alias("p95"))
    rows = s.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    below = [(F.sum((F.col("confidence") < F.col(c)).cast("long")), F.sum((F.col("confidence") <= F.col(c)).cast("long")))
             for c in ("median", "p95")]
    exact = rows.join(d, ["camera_id", "day"]).groupBy("camera_id", "day", "n", "about").agg(
        F.countDistinct("global_id").alias("n_people"), F.count("confidence").alias("m"),
        *[x.alias(f"{side}{i}") for i, pair in enumerate(below) for side, x in zip("lh", pair)])

    def rank_within(i, p):          # the ranks that the value holds reach the asked one, within the bound
        slack = sketches.RANK_ERROR * F.col("m") + 1
        return (F.col(f"l{i}") - slack <= p * F.col("m")) & (F.col(f"h{i}") + slack >= p * F.col("m"))
    near = F.abs(F.col("about") - F.col("n_people")) <= sketches.COUNT_ERROR * F.col("n_people") + 1
    return exact.select("camera_id", "day", "n", "n_people", near.alias("people_within"),
                        rank_within(0, 0.5).alias("median_within"), rank_within(1, 0.95).alias("p95_within"))


def _islands_sql(gap: bool, name: str) -> str:
    cond = "prev_camera_id IS NULL OR prev_camera_id <> camera_id"
    if gap:
        cond += " OR (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 > 86400"
    return f""", flagged AS (SELECT *, CASE WHEN {cond} THEN 1 ELSE 0 END AS brk FROM moves),
numbered AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY global_id ORDER BY ts, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS {name} FROM flagged)
"""


@query("stays_and_dwell", _MOVES + _islands_sql(True, "stay_no") + """
SELECT global_id, stay_no, camera_id, min(ts) AS start_ts, max(ts) AS end_ts,
       CAST(count(*) AS BIGINT) AS n_sightings,
       (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS dwell_s
FROM numbered GROUP BY global_id, stay_no, camera_id""")
def stays_and_dwell(spark, sf):
    s = sightings(spark, sf).select("event_id", "global_id", "camera_id", "ts")
    return crowd.stays(s, max_gap_s=86400.0)


_LEGS = _MOVES + _islands_sql(False, "leg_no") + """, legs AS (
  SELECT global_id, leg_no, camera_id, min(ts) AS first_ts, max(ts) AS last_ts,
         CAST(count(*) AS BIGINT) AS n_sightings
  FROM numbered GROUP BY global_id, leg_no, camera_id)
"""


def _legs(spark, sf):
    s = sightings(spark, sf).select("event_id", "global_id", "camera_id", "ts")
    st = crowd.stays(s, max_gap_s=None, out="leg_no")
    return st.select("global_id", "leg_no", "camera_id", F.col("start_ts").alias("first_ts"),
                     F.col("end_ts").alias("last_ts"), "n_sightings")


@query("trajectories", _LEGS + "SELECT * FROM legs")
def trajectories(spark, sf):
    """V8: each person's trajectory as ordered camera legs (one row per leg,
    so a long trajectory is never gathered into one value)."""
    return _legs(spark, sf)


@query("trajectory_points", _MOVES + _islands_sql(False, "leg_no") + """
SELECT global_id, leg_no, event_id, camera_id, ts, confidence, position_id FROM numbered""")
def trajectory_points(spark, sf):
    """V8 with every sighting of a leg: its record, time and place, one row
    each, so nothing is gathered."""
    s = sightings(spark, sf)
    return numbered_runs(s, ["global_id"], ["ts", "event_id"], F.date_trunc("day", F.col("ts")), ["camera_id"],
                         lambda p, c: p["camera_id"] != c["camera_id"], "leg_no").select(
        "global_id", "leg_no", "event_id", "camera_id", "ts", "confidence", "position_id")


@query("top_routes", _LEGS + """
, routes AS (SELECT a.global_id, a.camera_id || '>' || b.camera_id || '>' || c.camera_id AS route
             FROM legs a JOIN legs b ON a.global_id = b.global_id AND b.leg_no = a.leg_no + 1
             JOIN legs c ON a.global_id = c.global_id AND c.leg_no = a.leg_no + 2)
SELECT route, CAST(count(*) AS BIGINT) AS n_routes, CAST(count(DISTINCT global_id) AS BIGINT) AS n_people
FROM routes GROUP BY route ORDER BY n_routes DESC, route LIMIT 20""")
def top_routes(spark, sf):
    r = crowd.routes(_legs(spark, sf), "global_id", "leg_no", 3)
    g = r.groupBy("route").agg(F.count(F.lit(1)).alias("n_routes"),
                               F.countDistinct("global_id").alias("n_people"))
    return g.orderBy(F.col("n_routes").desc(), "route").limit(20)


@query("person_last_seen", S_ + """
SELECT global_id, camera_id, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY global_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM sightings) WHERE rn = 1""")
def person_last_seen(spark, sf):
    s = sightings(spark, sf).select("event_id", "global_id", "camera_id", "ts")
    return stats.latest_per_key(s, ["global_id"], ["ts", "event_id"], ["camera_id", "ts", "event_id"])


@query("active_persons", S_ + """
, recent AS (SELECT * FROM sightings WHERE ts > (SELECT max(ts) FROM sightings) - INTERVAL 24 HOUR)
SELECT global_id, CAST(count(*) AS BIGINT) AS n_recent, max(ts) AS last_ts,
       arg_max(camera_id, ts) AS last_camera_id
FROM recent GROUP BY global_id""")
def active_persons(spark, sf):
    """R10 (batch twin): people seen in the last 24 h of the data. The
    data's end time is a scalar subquery, not a driver round trip."""
    s = sightings(spark, sf).select("event_id", "global_id", "camera_id", "ts")
    end = s.agg(F.max("ts")).scalar()
    recent = s.where(F.col("ts") > end - F.expr("INTERVAL 24 HOURS"))
    return recent.groupBy("global_id").agg(
        F.count(F.lit(1)).alias("n_recent"), F.max("ts").alias("last_ts"),
        F.max_by("camera_id", F.struct("ts", "event_id")).alias("last_camera_id"))


# Fixed parameters (our choice): 1 h horizon, 0.005 m/s ceiling on the
# implied ground speed between two cameras.
GATE_HORIZON_S = 3600
GATE_VMAX = 0.005


@query("spatiotemporal_gate", S_ + f"""
, nx AS (SELECT global_id, event_id, camera_id, ts, position_id,
                lead(event_id) OVER w AS b_event_id, lead(camera_id) OVER w AS b_camera_id,
                lead(ts) OVER w AS b_ts, lead(position_id) OVER w AS b_position_id
         FROM sightings WINDOW w AS (PARTITION BY global_id ORDER BY ts, event_id)),
p AS (SELECT global_id, event_id AS a_event_id, b_event_id, camera_id AS a_camera_id, b_camera_id,
             (epoch_us(b_ts) - epoch_us(ts)) / 1e6 AS dt_s,
             sqrt(power({_X.replace('position_id', 'b_position_id')} - {_X}, 2)
                + power({_Y.replace('position_id', 'b_position_id')} - {_Y}, 2)) AS dist_m
      FROM nx WHERE b_event_id IS NOT NULL AND camera_id <> b_camera_id)
SELECT global_id, a_event_id, b_event_id, a_camera_id, b_camera_id, round(dt_s, 6) AS dt_s,
       round(dist_m, 6) AS dist_m, round(dist_m / dt_s, 9) AS speed_mps
FROM p WHERE dt_s > 0 AND dt_s <= {GATE_HORIZON_S} AND dist_m / dt_s <= {GATE_VMAX}""")
def spatiotemporal_gate(spark, sf):
    """Cross-camera steps of one person that are physically plausible:
    the person's next sighting, within the horizon, on another camera, at
    an implied ground speed <= vmax. The next sighting comes from the
    bucketed ``with_neighbor`` (one row per sighting), so the work is
    linear in the sightings; no pairs within a person are formed."""
    s = sightings(spark, sf).select("event_id", "global_id", "camera_id", "ts", "position_id")
    n = crowd.next_steps(s, "global_id")
    dt = elapsed_seconds(F.col("ts"), F.col("next_ts"))
    dx = ground_x(F.col("next_position_id")) - ground_x(F.col("position_id"))
    dy = ground_y(F.col("next_position_id")) - ground_y(F.col("position_id"))
    p = (n.where(F.col("next_event_id").isNotNull() & (F.col("camera_id") != F.col("next_camera_id")))
         .withColumn("dt_s", dt).withColumn("dist_m", F.sqrt(dx * dx + dy * dy))
         .withColumn("speed", F.col("dist_m") / F.col("dt_s")))
    p = p.where((F.col("dt_s") > 0) & (F.col("dt_s") <= GATE_HORIZON_S) & (F.col("speed") <= GATE_VMAX))
    return p.select("global_id", F.col("event_id").alias("a_event_id"), F.col("next_event_id").alias("b_event_id"),
                    F.col("camera_id").alias("a_camera_id"), F.col("next_camera_id").alias("b_camera_id"),
                    F.round("dt_s", 6).alias("dt_s"), F.round("dist_m", 6).alias("dist_m"),
                    F.round("speed", 9).alias("speed_mps"))


@query("pseudonymize_ids", S_ + f"""
SELECT event_id, sha256('salt' || global_id) AS pseudo_id, camera_id, date_trunc('hour', ts) AS hour,
       CAST(floor({_X}) AS BIGINT) AS cell_x, CAST(floor({_Y}) AS BIGINT) AS cell_y
FROM sightings""")
def pseudonymize_ids(spark, sf):
    return crowd.pseudonymise(sightings(spark, sf), salt="salt", cell_m=1.0)


@query("peak_occupancy", S_ + """
, ev AS (SELECT camera_id, ts AS t, 1 AS delta, event_id AS tie FROM sightings
         UNION ALL SELECT camera_id, ts + INTERVAL 1 HOUR, -1, event_id FROM sightings),
run AS (SELECT camera_id, t, sum(delta) OVER (PARTITION BY camera_id ORDER BY t, delta, tie
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS occ FROM ev)
SELECT camera_id, CAST(max(occ) AS BIGINT) AS peak, arg_min(t, (-occ, t)) AS peak_ts FROM run GROUP BY camera_id""")
def peak_occupancy(spark, sf):
    s = sightings(spark, sf).select("event_id", "camera_id", "ts")
    return crowd.occupancy_peak(s)


SESSION_GAP_S = 1800


@query("sessions_per_person", S_ + f"""
, g AS (SELECT *, lag(ts) OVER (PARTITION BY global_id ORDER BY ts, event_id) AS prev_ts FROM sightings),
f AS (SELECT *, CASE WHEN prev_ts IS NULL OR (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 >= {SESSION_GAP_S}
                     THEN 1 ELSE 0 END AS brk FROM g),
n AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY global_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_no FROM f)
SELECT global_id, session_no, min(ts) AS session_start, max(ts) + INTERVAL {SESSION_GAP_S} SECOND AS session_end,
       CAST(count(*) AS BIGINT) AS n_sightings
FROM n GROUP BY global_id, session_no""")
def sessions_per_person(spark, sf):
    """R5 batch twin: 30-minute activity sessions per person."""
    s = sightings(spark, sf).select("event_id", "global_id", "ts")
    return crowd.sessions(s, "global_id", SESSION_GAP_S)
