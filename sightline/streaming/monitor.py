"""Stream health (A9, R12): throughput, latency and backlog per micro-batch.

``StreamingQueryProgress`` already carries what a hand-written consumer
counts: input rows, input and processing rates, trigger duration, and
per-source offsets. ``ProgressLog`` is a listener that appends every update
of every query to a table, so totals cover the whole run and not only the
updates that Spark still holds (``numRecentProgressUpdates``);
``progress_frame`` turns a list of updates into the same columns.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sightline.operators.sequence import running_total

PROGRESS_SCHEMA = ("batch_id long, ts string, input_rows long, input_rows_per_s double, "
                   "processed_rows_per_s double, trigger_ms long, sources string")


def progress_frame(spark: SparkSession, progress: list) -> DataFrame:
    rows = []
    for p in progress:
        d = p if isinstance(p, dict) else json.loads(p.json)
        rows.append((d.get("batchId"), d.get("timestamp"), d.get("numInputRows"),
                     d.get("inputRowsPerSecond"), d.get("processedRowsPerSecond"),
                     (d.get("durationMs") or {}).get("triggerExecution"),
                     json.dumps(d.get("sources", []))))
    df = spark.createDataFrame(rows, PROGRESS_SCHEMA)
    return df.withColumn("ts", F.to_timestamp("ts"))


class ProgressLog(StreamingQueryListener):
    """Appends each progress update to the Parquet table at ``path``.

    ``spark.streams.addListener(ProgressLog(spark, path))``; read it back
    with ``spark.read.parquet(path)``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress_frame(self.spark, [event.progress]).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


_SOURCES = "array<struct<description string, startOffset string, endOffset string, latestOffset string>>"
_OFFSETS = "map<string, map<string, bigint>>"


def partition_lag(progress_df: DataFrame) -> DataFrame:
    """Offsets by topic and partition as the source itself reports them:
    (batch_id, ts, source, topic, partition, start_offset, end_offset,
    latest_offset, read, lag). ``read`` rows were taken by the batch, ``lag``
    are still queued behind it. Sources without topics (files) have no rows; a
    partition that the batch had not started on, or whose latest offset is
    not reported, has null there."""
    s = progress_df.select("batch_id", "ts", F.posexplode(F.from_json("sources", _SOURCES)).alias("source", "s"))
    sides = {c: F.from_json(F.col("s." + c), _OFFSETS) for c in ("startOffset", "endOffset", "latestOffset")}
    s = s.select("batch_id", "ts", "source", *[c.alias(n) for n, c in sides.items()]).where("endOffset IS NOT NULL")
    t = s.select("*", F.explode("endOffset").alias("topic", "ends")).where("ends IS NOT NULL")
    p = t.select("*", F.explode("ends").alias("p", "end_offset"))

    def at(side: str):
        return F.try_element_at(F.try_element_at(F.col(side), F.col("topic")), F.col("p"))
    p = p.select("batch_id", "ts", "source", "topic", F.col("p").try_cast("int").alias("partition"),
                 at("startOffset").alias("start_offset"), "end_offset", at("latestOffset").alias("latest_offset"))
    return p.select("*", (F.col("end_offset") - F.col("start_offset")).alias("read"),
                    (F.col("latest_offset") - F.col("end_offset")).alias("lag"))


def queue_sizes(progress_df: DataFrame) -> DataFrame:
    """A9 from the source: per topic the rows that its last report left
    queued, with the number of partitions that report and the worst of them."""
    lag = partition_lag(progress_df).where("lag IS NOT NULL")
    last = lag.groupBy("topic", "partition").agg(F.max_by(F.struct("lag", "ts"), "batch_id").alias("r"))
    return last.groupBy("topic").agg(F.sum("r.lag").alias("queued"), F.count(F.lit(1)).alias("partitions"),
                                     F.max("r.lag").alias("worst"), F.max("r.ts").alias("as_of"))


def backlog(progress_df: DataFrame) -> DataFrame:
    """Rows that arrived faster than they were processed, per batch and in
    total so far (positive = the stream is falling behind), from the rates;
    ``queue_sizes`` has the queue itself where the source reports offsets. The
    total is summed in buckets of 4,096 batches."""
    lag = (F.col("input_rows_per_s") - F.col("processed_rows_per_s")) * F.col("trigger_ms") / 1000.0
    df = progress_df.withColumn("batch_backlog", F.coalesce(lag, F.lit(0.0)))
    return running_total(df, [], ["batch_id"], F.floor(F.col("batch_id") / 4096), F.col("batch_backlog"),
                         "running_backlog")
