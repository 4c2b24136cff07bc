"""Sinks (K1-K3, K5, K9-K12) and the one-query fan-out.

Two sinks on one streaming DataFrame are two queries and score every
frame twice; ``fan_out`` builds one ``foreachBatch`` function that
persists the micro-batch once and hands it to every sink. File outputs
are written per batch id into their own folder with overwrite, so a
replayed batch (after a failure) replaces its own output instead of
adding duplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

BatchSink = Callable[[DataFrame, int], None]


def kafka_writer(kv: DataFrame, brokers: str, topic: str | None, checkpoint: str,
                 trigger_s: float | None = None) -> DataStreamWriter:
    """``key``/``value`` (string or binary) to Kafka, append mode.

    Without ``topic`` the rows must carry a ``topic`` column (one sink for
    every result kind)."""
    w = (kv.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if topic:
        w = w.option("topic", topic)
    if trigger_s:
        w = w.trigger(processingTime=f"{trigger_s} seconds")
    return w


def kafka_batch_write(kv: DataFrame, brokers: str, topic: str) -> None:
    """K5 batch form: publish a DataFrame of key/value rows once."""
    (kv.write.format("kafka").option("kafka.bootstrap.servers", brokers)
       .option("topic", topic).save())


def publish_results(results: dict[str, tuple[DataFrame, list[str]]], brokers: str, prefix: str,
                    publish: Callable[[DataFrame, str, str], None] = kafka_batch_write) -> None:
    """Republish every kind of result (tracks, identities, alerts,
    flows, ...): kind -> (rows, key columns). Each kind goes to its topic
    ``<prefix>-<kind>`` as JSON with all its fields, under its key."""
    from pyspark.sql import functions as F
    for kind, (rows, keys) in results.items():
        kv = rows.select(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"),
                         F.to_json(F.struct(*rows.columns)).alias("value"))
        publish(kv, brokers, f"{prefix}-{kind}")


def console_writer(df: DataFrame, rows: int = 5, truncate: bool = False,
                   trigger_s: float | None = None) -> DataStreamWriter:
    """K2/K3: console monitor."""
    w = (df.writeStream.format("console").option("numRows", str(rows))
         .option("truncate", str(truncate).lower()).outputMode("append"))
    if trigger_s:
        w = w.trigger(processingTime=f"{trigger_s} seconds")
    return w


def parquet_batch_sink(path: str, partition_by: tuple[str, ...] = ()) -> BatchSink:
    """K9: idempotent per-batch Parquet output (``batch_id=N`` folders)."""
    def sink(df: DataFrame, batch_id: int) -> None:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return sink


def console_batch_sink(rows: int = 5) -> BatchSink:
    """K2 inside a fan-out: show the first rows of each batch (L4)."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df.show(rows, truncate=False)
    return sink


def jdbc_batch_sink(url: str, table: str, properties: dict[str, str]) -> BatchSink:
    """Append each batch to a relational table (driver jar required).

    Rows of a replayed batch are appended again: give the table a key on
    (camera_id, frame_id) or upsert downstream."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.jdbc(url, table, mode="append", properties=properties)
    return sink


def avro_value(df: DataFrame, cols: list[str]):
    """Avro-encoded value column; needs the spark-avro package."""
    try:
        from pyspark.sql.avro.functions import to_avro
    except ImportError as e:                      # pragma: no cover - optional package
        raise RuntimeError("Avro encoding needs the spark-avro package") from e
    from pyspark.sql import functions as F
    return to_avro(F.struct(*[F.col(c) for c in cols]))


def fan_out(sinks: dict[str, tuple[Callable[[DataFrame], DataFrame], BatchSink]]) -> BatchSink:
    """One ``foreachBatch`` function feeding several sinks from one batch.

    ``sinks`` maps a name to (transform of the batch, sink). The batch is
    persisted once, so scoring upstream of ``foreachBatch`` runs once.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for _, (transform, sink) in sinks.items():
                sink(transform(batch), batch_id)
        finally:
            batch.unpersist()
    return run
