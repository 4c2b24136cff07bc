"""A key holding most rows is spread over many tasks (not one)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sightline.operators.sequence import numbered_runs, running_total
from sightline.operators.stats import exact_percentile


import pytest


@pytest.fixture(autouse=True)
def _no_coalescing(spark):
    # small test data would otherwise be coalesced into one partition by AQE
    # (and its local shuffle reader would report map-side partition ids)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.localShuffleReader.enabled", "false")
    # and these small "big" sides must not be broadcast, as they would not be at scale
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.localShuffleReader.enabled", "true")


def _hot(spark, n=20000):
    # 90 % of the rows belong to camera "hot", spread over 40 days
    return (spark.range(n)
            .withColumn("k", F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot")))
            .withColumn("ts", F.timestamp_seconds(F.col("id") * 173))
            .withColumn("v", (F.col("id") * 7919) % 1000))


def _tasks_of_hot(df, col):
    """Tasks holding the hot key's rows where ``col`` is computed (the
    column is aggregated so the operator producing it is not pruned)."""
    return (df.where(F.col("k") == "hot").groupBy(F.spark_partition_id().alias("p"))
            .agg(F.count(col).alias("n")).where("n > 0").count())


def test_running_total_spreads_a_hot_key(spark):
    df = _hot(spark)
    out = running_total(df, ["k"], ["ts", "id"], F.date_trunc("day", "ts"), F.col("v"), "run")
    plain = df.withColumn("run", F.sum("v").over(Window.partitionBy("k").orderBy("ts", "id")))
    assert _tasks_of_hot(plain, "run") == 1
    assert _tasks_of_hot(out, "run") > 1
    assert sorted(out.select("id", "run").collect()) == sorted(plain.select("id", "run").collect())


def test_runs_spread_a_hot_key(spark):
    df = _hot(spark).withColumn("cam", (F.col("id") / 50).cast("int") % 3)
    out = numbered_runs(df, ["k"], ["ts", "id"], F.date_trunc("day", "ts"), ["cam"],
                        lambda p, c: p["cam"] != c["cam"], "run_no")
    assert _tasks_of_hot(out, "run_no") > 1
    w = Window.partitionBy("k").orderBy("ts", "id")
    brk = (F.lag("cam").over(w).isNull() | (F.lag("cam").over(w) != F.col("cam"))).cast("long")
    plain = df.withColumn("b", brk).withColumn("run_no", F.sum("b").over(w))
    assert sorted(out.select("id", "run_no").collect()) == sorted(plain.select("id", "run_no").collect())


def test_exact_median_of_a_hot_key_is_range_split(spark):
    df = _hot(spark)
    srt = df.repartitionByRange(8, "k", "v")
    assert _tasks_of_hot(srt, "v") > 1             # the range partitioner splits the hot key
    got = {r.k: r.pct for r in exact_percentile(df, ["k"], "v", 0.5).collect()}
    want = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("v", 0.5).alias("p")).collect()}
    assert got == want


def test_box_pairs_of_a_crowded_frame_are_spread(spark):
    from sightline.operators.boxes import iou_pairs
    n = 3000
    boxes = (spark.range(n).withColumn("frame_id", F.lit(1))
             .withColumn("k", F.lit("hot")).withColumnRenamed("id", "det_seq")
             .withColumn("x1", ((F.col("det_seq") * 37) % 1880).cast("double"))
             .withColumn("y1", ((F.col("det_seq") * 53) % 1040).cast("double"))
             .withColumn("x2", F.col("x1") + 40).withColumn("y2", F.col("y1") + 40))
    pairs = iou_pairs(boxes, ["frame_id"]).withColumn("k", F.lit("hot"))
    assert _tasks_of_hot(pairs, "iou") > 1


def test_asof_of_a_hot_person_is_spread(spark):
    from sightline.operators.matching import asof_join
    df = _hot(spark)
    left = df.where(F.col("id") % 2 == 0).select("k", "id", "ts")
    right = df.where(F.col("id") % 2 == 1).select("k", F.col("id").alias("rid"), "ts")
    out = asof_join(left, right, ["k"], "ts", ["rid"])
    assert _tasks_of_hot(out, "match_rid") > 1
    got = {r.id: r.match_rid for r in out.collect()}
    assert all(got[i] == (i - 1 if i > 1 else None) for i in range(0, 20000, 2) if i % 10 != 0 and i > 10)
