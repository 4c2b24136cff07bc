"""Exact dedup, line dedup and SimHash near-dedup against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from sightline.llm import exact_dedup, line_dedup, simhash
from tests.llm import brute
from tests.llm.conftest import ODD, rows_of

ODD_TEXTS = [(r[0], r[1]) for r in ODD]


def test_exact_on_odd_rows(odd, empty):
    want = sorted(brute.exact(ODD_TEXTS), key=repr)
    for bits in (1 << 24, 1 << 15):  # also with a bitmap that lets much through
        assert rows_of(exact_dedup.exact_dedup(odd, prefix=4, bits=bits)) == want
    assert exact_dedup.exact_dedup(empty).collect() == []


def test_exact_refines_by_prefix_and_length(spark):
    """Same length; same length and prefix; same text but for blanks."""
    rows = [(1, "aaaab"), (2, "bbbbb"), (3, "aaaac"), (4, "aaaa b"), (5, "aaaa  b"), (6, "zzzzzz")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(df, prefix=4).collect()}
    assert got == {1: (5, 3), 4: (5, 3), 5: (5, 3), 2: (2, 1), 3: (3, 1), 6: (6, 1)}
    n = exact_dedup.survivors(df, prefix=4).count()
    assert n == 4  # 1, 3, 4, 5 share length and prefix


def test_drop_exact_keeps_all_columns(odd):
    out = exact_dedup.drop_exact_duplicates(odd)
    assert out.columns == odd.columns
    ids = [r.doc_id for r in out.collect()]
    # of the blank texts the longest stays, id 5; rows without an id go like any other
    assert sorted(ids) == [2, 2, 5, 6, 7, 8, 9]


def test_line_dedup_on_documents(docs, doc_rows):
    d = line_dedup.line_dedup(docs, min_docs=10)
    got = rows_of(d.select("doc_id", "lines", "dropped", F.sha2("kept_text", 256)))
    want = sorted(brute.line_dedup(doc_rows), key=repr)
    assert got == want
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (5, 3)])
def test_line_runs_compact_to_the_same(spark, batches, fanout):
    rnd = random.Random(batches)
    rows = [(i, "\n".join(rnd.choice(["A ", "a", " b", "c\t", "D", "", "e%d" % rnd.randrange(40)]) for _ in range(6)))
            for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    d = line_dedup.line_dedup(df, min_docs=7, batches=batches, fanout=fanout)
    got = rows_of(d.select("doc_id", "lines", "dropped", F.sha2("kept_text", 256)))
    assert got == sorted(brute.line_dedup(rows, 7), key=repr)


def test_line_dedup_on_odd_rows(odd, empty):
    d = line_dedup.line_dedup(odd, min_docs=2)
    got = rows_of(d.select("doc_id", "lines", "dropped", F.sha2("kept_text", 256)))
    assert got == sorted(brute.line_dedup(ODD_TEXTS, 2), key=repr)
    assert line_dedup.line_dedup(empty).collect() == []


def test_simhash_on_documents_and_odd_rows(docs, doc_rows, odd, empty):
    assert rows_of(simhash.simhash_near_dedup(docs)) == sorted(brute.simhash(doc_rows), key=repr)
    assert rows_of(simhash.simhash_near_dedup(odd)) == sorted(brute.simhash(ODD_TEXTS), key=repr)
    assert simhash.simhash_near_dedup(empty).collect() == []


@pytest.mark.parametrize("bucket,clusters,each", [(2048, 12, 25), (4, 3, 8), (1, 1, 3)])
def test_simhash_links_are_whole_at_any_bucket_size(spark, bucket, clusters, each):
    """Clusters of close fingerprints, so that small buckets go through the
    second and third level of the index."""
    rnd = random.Random(2)
    fps = set()
    for _ in range(clusters):
        f = rnd.getrandbits(64)
        for _ in range(each):
            g = f
            for _ in range(rnd.randrange(5)):
                g ^= 1 << rnd.randrange(24 if bucket < 2048 else 64)
            fps.add(g)
    signed = [(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for r in simhash.links(df, bucket=bucket).collect():
        a, b = r.src % (1 << 64), r.dst % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    assert {f: find(f) for f in fps} == brute.components(fps)


@pytest.mark.parametrize("bucket,clusters,each,chain", [(3, 4, 12, 24), (1, 3, 5, 10)])
def test_simhash_links_in_small_buckets_reach_every_byte(spark, bucket, clusters, each, chain):
    """Flips over all 64 bits, links that flip bits of each byte, and a chain
    in the last bytes, all through the second and third level."""
    rnd = random.Random(5)
    fps = set()
    for _ in range(clusters):
        f = rnd.getrandbits(64)
        for _ in range(each):
            g = f
            for _ in range(rnd.randrange(5)):
                g ^= 1 << rnd.randrange(64)
            fps.add(g)
    f = rnd.getrandbits(64)
    for byte in range(8):  # one, two and three bits, in this byte and the next
        fps |= {f, f ^ 1 << 8 * byte, f ^ 1 << 8 * byte ^ 1 << (8 * byte + 11) % 64,
                f ^ 7 << 8 * byte}
    for a in range(chain):
        fps.add((1 << 60) | ((1 << a % 20) * 3) << 20 * (a // 20))
    signed = [(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps]
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    got = simhash.links(spark.createDataFrame(signed, "fp long"), bucket=bucket).collect()
    for r in got:
        a, b = r.src % (1 << 64), r.dst % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    assert {f: find(f) for f in fps} == brute.components(fps)


def test_keep_one_of_each_keeps_columns(odd):
    out = simhash.keep_one_of_each(odd)
    want = sorted((i for i, _, c in brute.simhash(ODD_TEXTS) if i == c), key=repr)
    assert out.columns == odd.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == want
