"""Record sources (S1, S2, S5, S7, S8, L3/R12): Kafka or files, batch or stream.

``records`` returns Kafka-shaped rows (key, value, topic, partition,
offset, timestamp) whatever the format, so every downstream transform
is the same. Kafka needs the connector on the classpath; file formats
(Parquet/JSON holding the same columns) serve tests and replays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sightline import schemas


def kafka_options(brokers: str, topics: str | None = None, pattern: str | None = None,
                  starting: str = "latest", max_per_trigger: int | None = None,
                  fail_on_data_loss: bool = False, group_id: str | None = None) -> dict[str, str]:
    """Options of the Kafka source.

    The per-trigger cap is a parameter with no default (an unbounded
    trigger keeps up with the source instead of letting lag grow, D9).
    ``subscribePattern`` (e.g. ``cam\\d+-frames``) subscribes to every
    camera at once (S7). Consumer-group progress lives in the query's
    checkpoint, not in committed group offsets (S5).
    """
    if (topics is None) == (pattern is None):
        raise ValueError("give exactly one of topics or pattern")
    o = {"kafka.bootstrap.servers": brokers, "startingOffsets": starting,
         "failOnDataLoss": str(fail_on_data_loss).lower()}
    if topics is not None:
        o["subscribe"] = topics
    else:
        o["subscribePattern"] = pattern
    if max_per_trigger is not None:
        o["maxOffsetsPerTrigger"] = str(int(max_per_trigger))
    if group_id:
        o["groupIdPrefix"] = group_id
    return o


def records(spark: SparkSession, fmt: str, path: str | None = None, stream: bool = True,
            max_files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Kafka-shaped records from Kafka (``fmt='kafka'``) or files."""
    if fmt == "kafka":
        r = spark.readStream if stream else spark.read
        return r.format("kafka").options(**options).load()
    r = (spark.readStream if stream else spark.read).format(fmt)
    if fmt != "parquet" or stream:
        r = r.schema(schemas.KAFKA_RECORD)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    r = r.options(**options)
    return r.load(path) if path else r.load()
