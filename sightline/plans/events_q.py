"""Queries over sightings/events: rates, latest values, buffers, as-of."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.functions.text import NODE_PREFIX, clock
from sightline.operators import stats
from sightline.operators.matching import asof_join
from sightline.operators.sequence import running_total
from sightline.plans.registry import query
from sightline.plans.sql_views import S_
from sightline.sources.tables import camera_of, sightings, table

_HOURLY_SQL = S_ + """, hourly AS (
  SELECT camera_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
         time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
         CAST(count(*) AS BIGINT) AS n
  FROM sightings GROUP BY 1, 2, 3)
"""


def _hourly(spark, sf):
    s = sightings(spark, sf).select("camera_id", "ts")
    return stats.tumbling_rate(s, "ts", "1 hour", 3600, ["camera_id"])


@query("fps_tumbling", _HOURLY_SQL + """
SELECT camera_id, window_start, window_end, n, round(n / 3600.0, 9) AS rate_per_s FROM hourly""")
def fps_tumbling(spark, sf):
    return _hourly(spark, sf).withColumn("rate_per_s", F.round("rate_per_s", 9))


@query("flushed_totals", _HOURLY_SQL + """
SELECT camera_id, window_start, n, cum_n FROM (
  SELECT camera_id, window_start, n,
         CAST(sum(n) OVER (PARTITION BY camera_id ORDER BY window_start
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_n,
         max(window_start) OVER (PARTITION BY camera_id) AS last_start
  FROM hourly) WHERE window_start < last_start""")
def flushed_totals(spark, sf):
    h = _hourly(spark, sf).select("camera_id", "window_start", "n")
    return stats.flushed_totals(h, ["camera_id"]).withColumn("cum_n", F.col("cum_n").cast("long"))


@query("latest_per_camera", S_ + """
SELECT camera_id, event_id, global_id, ts, strftime(ts, '%H:%M:%S') AS clock FROM (
  SELECT *, row_number() OVER (PARTITION BY camera_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM sightings) WHERE rn = 1""")
def latest_per_camera(spark, sf):
    s = sightings(spark, sf)
    latest = stats.latest_per_key(s, ["camera_id"], ["ts", "event_id"], ["event_id", "global_id", "ts"])
    return latest.withColumn("clock", clock(F.col("ts")))


def _shed(spark, sf, newest: bool):
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type")
    ev = ev.withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    order = [F.col("ts").desc(), F.col("event_id").desc()] if newest else [F.col("ts"), F.col("event_id")]
    return stats.keep_n(ev, ["event_type", "hour"], order, 3, "slot")


_SHED_SQL = """
SELECT event_id, ts, event_type, hour, slot FROM (
  SELECT event_id, ts, event_type, date_trunc('hour', ts) AS hour,
         CAST(row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY {o}) AS BIGINT) AS slot
  FROM events) WHERE slot <= 3"""


@query("shed_newest", _SHED_SQL.format(o="ts, event_id"))
def shed_newest(spark, sf):
    """L1: a full buffer drops new arrivals: the first 3 of each hour stay."""
    return _shed(spark, sf, newest=False)


@query("shed_oldest", _SHED_SQL.format(o="ts DESC, event_id DESC"))
def shed_oldest(spark, sf):
    """L2: a full buffer drops its oldest entry: the last 3 of each hour stay."""
    return _shed(spark, sf, newest=True)


@query("latency_by_node", """
SELECT 'spark-worker-' || CAST(user_id % 4 AS VARCHAR) AS node, CAST(count(*) AS BIGINT) AS n,
       round(avg(value), 6) AS avg_ms, max(value) AS max_ms,
       round(quantile_cont(value, 0.5), 6) AS p50_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms
FROM events GROUP BY 1""")
def latency_by_node(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "value")
    node = F.concat(F.lit(NODE_PREFIX), F.pmod("user_id", F.lit(4)).cast("string"))
    s = stats.latency_summary(ev, node, "value")
    return s.select("node", "n", F.round("avg_ms", 6).alias("avg_ms"), "max_ms",
                    F.round("p50_ms", 6).alias("p50_ms"), F.round("p95_ms", 6).alias("p95_ms"))


@query("backlog_per_window", """
SELECT day, produced, consumed, backlog,
       CAST(sum(backlog) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS running_backlog
FROM (SELECT CAST(ts AS DATE) AS day,
             CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS produced,
             CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS consumed,
             CAST(count(*) FILTER (WHERE event_type = 'view') - count(*) FILTER (WHERE event_type = 'click')
                  AS BIGINT) AS backlog
      FROM events GROUP BY 1)""")
def backlog_per_window(spark, sf):
    """Produced minus consumed per day and the queue it leaves behind.

    A view puts a frame into the queue and a click takes one out; the other
    event types are no queue events in this mapping. The running sum over
    the days is stitched from months.
    """
    ev = table(spark, sf, "events").select("ts", "event_type")
    per_day = ev.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.when(F.col("event_type") == "view", 1)).alias("produced"),
        F.count(F.when(F.col("event_type") == "click", 1)).alias("consumed"))
    per_day = per_day.withColumn("backlog", F.col("produced") - F.col("consumed"))
    return running_total(per_day, [], ["day"], F.date_trunc("month", F.col("day")), F.col("backlog"),
                         "running_backlog").withColumn("running_backlog", F.col("running_backlog").cast("long"))


_ASOF_SQL = """
WITH e AS (SELECT event_id, 'cam' || CAST(user_id % 7 + 1 AS VARCHAR) AS camera_id, ts FROM events),
r AS (SELECT camera_id, ts, max(event_id) AS event_id FROM e WHERE event_id % 2 = 0 GROUP BY camera_id, ts)
SELECT l.event_id, l.camera_id, l.ts, r.event_id AS match_event_id, r.ts AS match_ts
FROM (SELECT * FROM e WHERE event_id % 2 = 1) l ASOF LEFT JOIN r ON l.camera_id = r.camera_id AND l.ts >= r.ts"""


@query("asof_latest_frame", _ASOF_SQL)
def asof_latest_frame(spark, sf):
    """Every event is a frame (even ids) or a detection (odd ids) of the
    camera of its user; a detection takes its camera's latest frame, of
    equal times the one with the higher id."""
    e = table(spark, sf, "events").select("event_id", camera_of(F.col("user_id")).alias("camera_id"), "ts")
    left, right = e.where(F.col("event_id") % 2 == 1), e.where(F.col("event_id") % 2 == 0)
    return asof_join(left, right, ["camera_id"], "ts", [], tie="event_id").select(
        "event_id", "camera_id", "ts", "match_event_id", "match_ts")
