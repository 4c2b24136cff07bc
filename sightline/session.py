"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every sightline job relies on. Shuffle partitions are left to
# the caller (local tests want ~cores, a cluster wants data/128MB).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # One-line base64 (JSON envelopes must not carry MIME line breaks).
    "spark.sql.chunkBase64String.enabled": "false",
    # Stateless streaming micro-batches may use AQE as well.
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    # Top-k per group filters get a partial (map-side) limit.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def get_spark(master: str | None = None, app: str = "sightline",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the sightline defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.master.startswith("local"):
        ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, which import its functions."""
    import shutil
    root = os.path.dirname(os.path.abspath(__file__))
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="sightline-code-"), "sightline"), "zip",
                               os.path.dirname(root), os.path.basename(root))
    spark.sparkContext.addPyFile(made)


def remove_scratch(spark: SparkSession) -> None:
    """Delete the tables that this session's operators wrote to the shared
    folder. For the end of a run: DataFrames that read them are void then."""
    sc = _context(spark)
    if sc is None or not sc.getCheckpointDir():
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(os.path.join(sc.getCheckpointDir(), "tables"))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no driver-side context
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or one already set on
    the context). Only a local-mode session without one gets a private
    scratch folder, which is what tests run with; a cluster session with
    no shared folder configured is an error, since a machine-local folder
    would not survive the loss of an executor.
    """
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running iterative sightline operators")
        conf_dir = tempfile.mkdtemp(prefix="sightline-ckpt-")
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df, name: str = "step"):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back.

    Unlike ``Dataset.checkpoint()``, which computes the plan once for its
    count and again to write the checkpoint, this computes it once. The
    table survives executor loss like a reliable checkpoint does.
    """
    import uuid
    path = scratch_path(df.sparkSession, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
