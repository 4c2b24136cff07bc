import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.operators import sketches


def test_united_hours_are_within_bounds(spark):
    df = (spark.range(60_000).select(
        F.concat(F.lit("cam"), (F.col("id") % 2).cast("string")).alias("camera_id"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 4).alias("ts"),
        F.concat(F.lit("P"), (F.pmod(F.xxhash64("id"), F.lit(9000))).cast("string")).alias("who"),
        (F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1_000_000)) / 1e4).alias("ms")))
    hours = sketches.hourly_sketches(df, ["camera_id"], F.col("who"), F.col("ms")).cache()
    got = sketches.unite(hours, ["camera_id"]).select(
        "camera_id", "n", sketches.n_distinct().alias("people"), sketches.quantile(0.5).alias("p50"),
        sketches.quantile(0.95).alias("p95")).collect()
    for r in got:
        mine = df.where(F.col("camera_id") == r.camera_id)
        exact = mine.agg(F.countDistinct("who")).first()[0]
        ms = np.sort([x.ms for x in mine.select("ms").collect()])
        assert r.n == len(ms) and abs(r.people - exact) <= sketches.COUNT_ERROR * exact
        for p, v in ((0.5, r.p50), (0.95, r.p95)):
            assert abs(np.searchsorted(ms, v) / len(ms) - p) <= sketches.RANK_ERROR
    twice = sketches.unite(sketches.unite(hours, ["camera_id", F.date_trunc("day", "hour").alias("day")]), ["camera_id"])
    assert {(r.camera_id, r.people) for r in twice.select("camera_id", sketches.n_distinct().alias("people")).collect()} == \
        {(r.camera_id, r.people) for r in got}


def test_nulls_and_nothing(spark):
    df = spark.createDataFrame([("c", None, None, None), ("c", 5, "p", float("nan")), ("c", 5, "p", 2.0), ("d", 5, None, None)],
                               "camera_id string, s long, who string, v double").withColumn("ts", F.timestamp_seconds("s"))
    h = sketches.hourly_sketches(df, ["camera_id"], F.col("who"), F.col("v"))
    got = {r.camera_id: (r.n, r.people, r.p50) for r in sketches.unite(h, ["camera_id"]).select(
        "camera_id", "n", sketches.n_distinct().alias("people"), sketches.quantile(0.5).alias("p50")).collect()}
    assert got == {"c": (3, 1, 2.0), "d": (1, 0, None)}
    assert sketches.unite(h.limit(0), ["camera_id"]).count() == 0
