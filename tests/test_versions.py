import random
import threading

import pytest
from pyspark.sql import functions as F

from sightline.operators.identity import GrowingIdentities
from sightline.operators.graph import component_labels
from sightline.sources.versions import VersionedTable, versioned_batch_sink


def rows(t, version=None):
    return sorted(tuple(r) for r in t.read(version).collect())


def numbers(spark, a, b):
    return spark.range(a, b).select("id", (F.col("id") % 3).alias("cam"))


@pytest.mark.parametrize("by", [(), ("cam",)])
def test_versions_replay_and_compaction(spark, tmp_dir, by):
    t = VersionedTable(spark, f"{tmp_dir}/t", by)
    assert t.versions() == []
    with pytest.raises(ValueError):
        t.read()
    for i in range(4):
        assert t.append(numbers(spark, 10 * i, 10 * i + 10), "job", i)
    assert not t.append(numbers(spark, 20, 30), "job", 2)                   # replayed
    assert t.append(numbers(spark, 40, 45), "other", 0)
    want = [(i, i % 3) for i in range(45)]
    assert rows(t) == want and rows(t, 2) == want[:20]
    held = t.read()                                                          # a reader of version 5
    assert t.compact()
    assert len(t.manifest()["folders"]) == 1 and rows(t) == want
    assert sorted(tuple(r) for r in held.collect()) == want
    assert not t.compact()
    assert t.append(numbers(spark, 45, 50), "job", 4) and not t.append(numbers(spark, 45, 50), "job", 4)
    assert t.vacuum(keep=1) == 5 and rows(t) == [(i, i % 3) for i in range(50)]
    with pytest.raises(ValueError):
        t.read(1)
    with pytest.raises(ValueError):
        t.append(spark.range(3).select(F.col("id").cast("string").alias("id"), F.lit(1).cast("long").alias("cam")))


def test_a_write_that_is_not_committed_is_not_seen(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    t.append(numbers(spark, 0, 5))
    t._write(numbers(spark, 5, 9))                                         # a job that died before its commit
    assert rows(t) == [(i, i % 3) for i in range(5)]


def test_two_writers(spark, tmp_dir):
    """Both land, whoever commits first; a compaction in between loses nothing."""
    t = VersionedTable(spark, f"{tmp_dir}/t")
    t.append(numbers(spark, 0, 1))

    def write(k):
        for i in range(3):
            VersionedTable(spark, f"{tmp_dir}/t").append(numbers(spark, 100 * k + i, 100 * k + i + 1), f"q{k}", i)
    threads = [threading.Thread(target=write, args=(k,)) for k in (1, 2)]
    [x.start() for x in threads]
    VersionedTable(spark, f"{tmp_dir}/t").compact()
    [x.join() for x in threads]
    assert [r[0] for r in rows(t)] == [0, 100, 101, 102, 200, 201, 202]


def test_stream_sink(spark, tmp_dir):
    numbers(spark, 0, 40).repartition(8).write.parquet(f"{tmp_dir}/src")
    sink = versioned_batch_sink(f"{tmp_dir}/t", "frames", compact_after=3)
    src = spark.readStream.schema("id long, cam long").option("maxFilesPerTrigger", 2).parquet(f"{tmp_dir}/src")
    q = src.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_dir}/ck").start()
    q.processAllAvailable()
    q.stop()
    t = VersionedTable(spark, f"{tmp_dir}/t")
    assert rows(t) == [(i, i % 3) for i in range(40)] and len(t.manifest()["folders"]) < 4
    sink(numbers(spark, 0, 10), 0)                                           # the engine replays a batch
    assert len(rows(t)) == 40


def test_identities_grow_as_all_links_at_once(spark, tmp_dir):
    rnd = random.Random(3)
    links = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    links += [(7, 7), (None, 5), (3, None)] + links[:5]
    rnd.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    want = sorted(tuple(r) for r in component_labels(df, "a", "b").select("v", "component").collect())
    for batches in (1, 4):
        g = GrowingIdentities(spark, f"{tmp_dir}/g{batches}")
        for i in range(batches):
            part = spark.createDataFrame(links[i::batches], "a long, b long")
            assert g.add(part, "a", "b", "links", i)
            assert not g.add(part, "a", "b", "links", i)
        assert sorted(tuple(r) for r in g.labels().collect()) == want
    before = g.table.read().count()
    g.add(spark.createDataFrame([(100, 101)], "a long, b long"), "a", "b", "links", 9)
    assert g.table.read().count() == before                                # nothing changed, nothing written
    assert g.compact() and g.table.read().count() == len(want)
    assert sorted(tuple(r) for r in g.labels().collect()) == want


def test_identities_of_text_ids(spark, tmp_dir):
    g = GrowingIdentities(spark, f"{tmp_dir}/s")
    g.add(spark.createDataFrame([("b", "c"), ("x", "y")], "a string, b string"), "a", "b")
    g.add(spark.createDataFrame([("c", "a"), ("z", "q")], "a string, b string"), "a", "b")
    assert sorted(tuple(r) for r in g.labels().collect()) == [
        ("a", "a"), ("b", "a"), ("c", "a"), ("q", "q"), ("x", "x"), ("y", "x"), ("z", "q")]
