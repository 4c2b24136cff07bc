"""File and feed sources (S7-S15): naming, listing, history, completeness.

Listings use the ``binaryFile`` source without its ``content`` column,
so only file metadata is read; history tables are partitioned Parquet
so camera and date filters prune whole folders.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: camera id at the start of a topic or folder name.
CAMERA_PATTERN = r"^(cam\d+)"


def topic_of(camera: Column, kind: str) -> Column:
    """``cam3`` -> ``cam3-frames`` / ``cam3-detections``."""
    return F.concat(camera, F.lit("-" + kind))


def camera_of_topic(topic: Column) -> Column:
    """T16 reverse and D8: the camera comes from the topic, not a literal."""
    return F.regexp_extract(topic, CAMERA_PATTERN, 1)


def history_filter(df: DataFrame, cameras: Sequence[str], start: str, end: str,
                   camera_col: str = "camera_id", ts_col: str = "ts") -> DataFrame:
    """Camera list and half-open time range; both reach the scan."""
    return df.where(F.col(camera_col).isin(list(cameras))
                    & (F.col(ts_col) >= F.lit(start).cast("timestamp_ntz"))
                    & (F.col(ts_col) < F.lit(end).cast("timestamp_ntz")))


def write_history(df: DataFrame, path: str, ts_col: str = "ts",
                  camera_col: str = "camera_id", mode: str = "append", files_per_day: int = 8) -> None:
    """K9: long-term store partitioned by camera and day. A camera's day is
    dealt over ``files_per_day`` tasks by a hash of its time, so no task
    writes a whole busy day."""
    (df.withColumn("dt", F.to_date(ts_col))
       .repartition(camera_col, "dt", F.pmod(F.xxhash64(ts_col), F.lit(files_per_day)))
       .write.mode(mode).partitionBy(camera_col, "dt").parquet(path))


def read_history(spark: SparkSession, path: str, cameras: Sequence[str], start: str, end: str,
                 camera_col: str = "camera_id", ts_col: str = "ts") -> DataFrame:
    """Read back with partition pruning on camera and day."""
    df = spark.read.parquet(path)
    day_filter = ((F.col("dt") >= F.to_date(F.lit(start)))
                  & (F.col("dt") <= F.to_date(F.lit(end))))
    return history_filter(df.where(day_filter), cameras, start, end, camera_col, ts_col)


def missing_expected(seen: DataFrame, keys: Sequence[str], day_col: str) -> DataFrame:
    """Expected (key, day) inputs that never arrived.

    The expected list is every day between a key's first and last day,
    generated per key from its bounds (one ``sequence`` per key row), then
    anti-joined with the distinct days actually seen.
    """
    bounds = seen.groupBy(*keys).agg(F.min(day_col).alias("_d0"), F.max(day_col).alias("_d1"))
    expected = bounds.select(*keys, F.explode(F.sequence("_d0", "_d1", F.expr("INTERVAL 1 DAY")))
                             .alias(day_col))
    return expected.join(seen.select(*keys, day_col).distinct(), [*keys, day_col], "left_anti")


def list_files(spark: SparkSession, root: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """File listing (path, size, modification time), no content."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(root).select("path", "length", "modificationTime")


def read_frames_dir(spark: SparkSession, root: str, glob: str = "*.jpg") -> DataFrame:
    """A directory of frame images as a frames table.

    Camera and frame number come from the path (``.../C3/00000120.jpg``
    or ``cam3/frame_000120.jpg``) via ``regexp_extract``. A file whose path
    lacks one of them stays, with nulls and an ``error``.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(root))
    cam = F.regexp_extract("path", r"/(?:C|cam)(\d+)/[^/]+$", 1)
    num = F.regexp_extract("path", r"(\d+)\.[A-Za-z]+$", 1)
    camera = F.when(cam != "", F.concat(F.lit("cam"), cam))
    number = num.try_cast("long")
    return df.select(
        camera.alias("camera_id"),
        number.alias("frame_id"),
        F.col("modificationTime").cast("timestamp_ntz").alias("ts"),
        F.col("content").alias("payload"),
        "path",
        F.when(camera.isNull(), F.lit("no camera in the path"))
         .when(number.isNull(), F.lit("no frame number in the file name")).alias("error"))


def usage_rollup(df: DataFrame, levels: Sequence[str], size: Column) -> DataFrame:
    """Count and total size at every prefix of ``levels``."""
    return (df.withColumn("_sl_size", size).rollup(*levels)
            .agg(F.count(F.lit(1)).alias("n_files"), F.sum("_sl_size").cast("long").alias("total_bytes")))


def first_available(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that exists on its Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        if jp.getFileSystem(hconf).exists(jp):
            return p
    raise FileNotFoundError(f"none of the inputs exists: {list(paths)}")


def required_files_missing(spark: SparkSession, root: str, required: Sequence[str]) -> DataFrame:
    """Required relative paths that are absent under ``root``."""
    base = re.escape(root.rstrip("/").split(":", 1)[-1])
    listing = list_files(spark, root).select(F.regexp_extract("path", base + "/(.*)$", 1).alias("rel"))
    req = spark.createDataFrame([(r,) for r in required], "rel string")
    return req.join(listing, "rel", "left_anti")


def read_json_documents(spark: SparkSession, path: str, schema) -> DataFrame:
    """Per-frame annotation or calibration JSON files (one document
    per file, possibly pretty-printed). The layout belongs to the dataset,
    so the schema is an argument; the source file is kept as a column."""
    return (spark.read.schema(schema).option("multiLine", "true").json(path)
            .withColumn("source_file", F.input_file_name()))


def read_token_lines(spark: SparkSession, path: str, names: Sequence[str],
                     types: Sequence[str] | None = None) -> DataFrame:
    """Whitespace-separated text records (e.g. a rectangle list with
    one ``KIND camera id x1 y1 x2 y2`` line per box). Missing trailing
    tokens read as NULL; ``types`` casts the named columns."""
    toks = F.split(F.trim(F.col("value")), r"\s+")
    df = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    cols = [F.get(toks, i).alias(n) for i, n in enumerate(names)]
    out = df.select(*cols)
    if types:
        out = out.select(*[F.col(n).try_cast(t).alias(n) for n, t in zip(names, types)])
    return out
