"""SimHash near-dedup: byte-position inverted index with count filtering.

Fingerprint: 64 bits, each 1 if it is set in over half of the XXH64 hashes
(seed 42) of the text's word shingles.

Linking: two fingerprints at ``max_bits`` = 3 or fewer differing bits agree
in at least 5 of their 8 bytes, each at its position. Split the positions
into two halves of 4: of 5 agreeing ones, 3 lie in one half. So the index
holds every distinct fingerprint under the 8 triples of positional bytes of
one half, and every linked pair meets under one of them. Under a key, the
shared positional bytes of each pair are tallied from the XOR, pairs with
fewer than the guaranteed 5 are dropped, and the rest is verified by bit
count. A task emits the links of a spanning forest only: as many as it has
fingerprints, not pairs.

Common keys: a key with more than ``bucket`` fingerprints is not gathered.
Its fingerprints are indexed again, one level down, under the triple plus
each of the 10 pairs of the other 5 positions (a linked pair agrees in 2 of
them). Keys still too common there leave 3 bytes open, of which 3 bits
differ at most: the fingerprints are grouped under each of the 2,024 ways to
mask 3 of the 24 bits, and each links to the least one of its groups, which
a pre-aggregated minimum gives. All within a group differ in masked bits
only, so these links are real, and every linked pair shares a group. So no
group is capped and none is gathered beyond ``bucket`` rows.

Equal fingerprints are collapsed first, so copies cost one row a task. The
components come from ``operators.graph``. Only narrow rows are shuffled.

Defined cases: null text is empty; a text without words has fingerprint 0
and links like any other; null ids sort last; repeated rows each get their
row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from sightline.llm.common import fresh, map_columns, without_keys
from sightline.operators.graph import component_labels
from sightline.session import materialize

#: Seed of the shingle hash; letters that are lower-cased.
SEED = 42
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = b"abcdefghijklmnopqrstuvwxyz"

BYTES = 8
MAX_BITS = 3
#: The guaranteed number of shared positional bytes: each differing bit spoils one byte at most.
MIN_SHARED = BYTES - MAX_BITS
TRIPLES = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """Fingerprint of one text (unsigned)."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(bytes.maketrans(UPPER, LOWER))
    words = data.split()  # bytes.split: exactly the ASCII blanks 0x20, 0x09-0x0D
    if not words:
        return 0
    flat = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(flat, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = len(words) - shingle + 1
        hashes = np.fromiter([digest(flat[a:b], SEED) for a, b in
                              zip(starts[:n].tolist(), ends[shingle - 1:].tolist())], dtype=np.uint64, count=n)
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    n = len(hashes)
    count = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):
        part = np.ascontiguousarray(hashes[at:at + 4096], dtype=">u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = (count * 2 > n).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, k, fp): hash of id and text, the fingerprint as a signed 64-bit
    number."""
    def batch(_state, texts: pa.Array) -> list:
        made = np.array([fingerprint_of(t, shingle) for t in texts.to_pylist()], dtype=np.uint64)
        return [pa.array(made.view(np.int64))]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"),
                       F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("k"))
    return map_columns(rows, batch, ["t"], [StructField("fp", LongType())], keep=["id", "k"])


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * (7 - position)).bitwiseAND(F.lit(255))


def _bytes_key(fp: Column, positions: tuple[int, ...]) -> Column:
    """The bytes at the positions, in place, the others 0."""
    mask = sum(255 << (8 * (7 - p)) for p in positions)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask))


def _forest(rows: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Spanning links of one key's fingerprints. A row of the matrix is
    compared with all later ones at a time, so memory is linear."""
    fp = np.unique(rows["fp"].to_numpy(dtype=np.int64)).view(np.uint64)
    n = len(fp)
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    a, b = [], []
    for i in range(n - 1):
        x = fp[i + 1:] ^ fp[i]
        shared = BYTES - np.count_nonzero(x.view(np.uint8).reshape(-1, 8), axis=1)   # tally
        at = np.flatnonzero(shared >= BYTES - max_bits)                              # count filter
        at = at[np.bitwise_count(x[at]) <= max_bits]                                 # verification
        ri = find(i)
        for j in (at + (i + 1)).tolist():
            rj = find(j)
            if ri != rj:
                parent[rj] = ri
                a.append(i)
                b.append(j)
    return pd.DataFrame({"src": fp[a].view(np.int64) if a else np.empty(0, np.int64),
                         "dst": fp[b].view(np.int64) if b else np.empty(0, np.int64)})


def _split(postings: DataFrame, by: list[str], bucket: int) -> tuple[DataFrame, DataFrame]:
    """(postings of keys with 2..bucket rows, those of keys with more)."""
    n = postings.groupBy(*by).agg(F.count(F.lit(1)).alias("n_key")).where("n_key > 1")
    both = postings.join(n, by)
    return both.where(F.col("n_key") <= bucket).drop("n_key"), both.where(F.col("n_key") > bucket).drop("n_key")


def links(fps: DataFrame, bucket: int = 2048, max_bits: int = MAX_BITS) -> DataFrame:
    """(src, dst) links that connect exactly the fingerprints (column ``fp``,
    distinct) that a chain of links of ``max_bits`` or fewer bits connects."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the index guarantees {MAX_BITS} differing bits at most")

    def linked(small: DataFrame, by: list[str]) -> DataFrame:
        return small.groupBy(*by).applyInPandas(lambda rows: _forest(rows[["fp"]], max_bits), "src long, dst long")

    fp = F.col("fp")
    first = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), _bytes_key(fp, t).alias("key")) for i, t in enumerate(TRIPLES)])).alias("x"))
    first = first.select("fp", "x.part", "x.key")
    small, large = _split(first, ["part", "key"], bucket)
    out = linked(small, ["part", "key"])
    large = large.transform(lambda d: materialize(d, "simhash-large"))
    if large.isEmpty():
        return out
    # one level down: the triple and two more positions
    ways = [(i, t + p) for i, t in enumerate(TRIPLES) for p in combinations(sorted(set(range(8)) - set(t)), 2)]
    finer = large.select("fp", "part", F.explode(F.array(*[
        F.struct(F.lit(i).alias("of"), F.lit(w).alias("way"), _bytes_key(fp, t).alias("key"))
        for w, (i, t) in enumerate(ways)])).alias("x")).where("x.of = part").select("fp", "x.way", "x.key")
    small, large = _split(finer, ["way", "key"], bucket)
    out = out.unionByName(linked(small, ["way", "key"]))
    large = large.transform(lambda d: materialize(d, "simhash-larger"))
    if large.isEmpty():
        return out
    # three open bytes: group under every mask of max_bits of their 24 bits
    def masks(batches):
        for b in batches:
            f, w = b["fp"].to_numpy(dtype=np.int64), b["way"].to_numpy()
            for way in np.unique(w):
                free = [8 * (7 - p) + k for p in sorted(set(range(8)) - set(ways[way][1])) for k in range(8)]
                clear = np.array([~sum(1 << x for x in c) & (2 ** 64 - 1) for c in combinations(free, max_bits)],
                                 dtype=np.uint64).view(np.int64)
                mine = f[w == way]
                for a in range(0, len(mine), 256):
                    part = mine[a:a + 256]
                    yield pd.DataFrame({"fp": np.repeat(part, len(clear)), "way": way,
                                        "mask": np.tile(np.arange(len(clear), dtype=np.int32), len(part)),
                                        "key": (part[:, None] & clear[None, :]).ravel()})
    masked = large.select("fp", "way").mapInPandas(masks, "fp long, way int, mask int, key long")
    least = masked.groupBy("way", "mask", "key").agg(F.min("fp").alias("src"), F.count(F.lit(1)).alias("n"))
    least = least.where("n > 1").drop("n")
    star = masked.join(least, ["way", "mask", "key"]).where("src <> fp").select("src", F.col("fp").alias("dst"))
    return out.unionByName(star.distinct())


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               max_bits: int = MAX_BITS, bucket: int = 2048) -> DataFrame:
    """(id, k, fp, component_id) of every document."""
    rows = fingerprints(docs, id_col, text_col, shingle).transform(lambda d: materialize(d, "simhash"))
    distinct = rows.groupBy("fp").agg(F.min("id").alias("least_id")).transform(lambda d: materialize(d, "simhash-fp"))
    lab = component_labels(links(distinct.select("fp"), bucket, max_bits)).withColumnRenamed("v", "fp")
    named = distinct.join(lab, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "least_id")
    comp = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_fp = named.select("fp", "component").join(comp, "component").select("fp", "component_id").transform(
        lambda d: materialize(d, "simhash-comp"))
    return rows.join(of_fp, "fp").select("id", "k", "fp", "component_id")


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id
    (least id reachable over links)."""
    return components(docs, id_col, text_col, **options).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows (all columns) whose id is the least of its component."""
    gone = (components(docs, id_col, text_col, **options)
            .where(~F.col("id").eqNullSafe(F.col("component_id")))
            .select("k", "id").distinct().transform(lambda d: materialize(d, "simhash-gone")))
    key = fresh("row_key", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))))
    return without_keys(keyed, key, gone, "k", same={id_col: "id"}).select(*docs.columns)
