"""Line dedup over levelled sorted runs of line hashes.

The documents arrive in batches. A batch's distinct line keys are counted
per document; those already known to be common are anti-joined away, the
rest becomes a sorted run of (hash, documents) on level 0. When a level
holds ``fanout`` runs they are compacted: merged by hash, their counts
added, keys that have reached the threshold moved to the common keys, the
others written as one sorted run on the next level. The last compaction
merges all levels. So a key is common exactly if its counts over all runs
reach the threshold, and the common keys are few next to the lines.

Keys are 128-bit hashes of the stripped, lower-cased line. Counting is
pre-aggregated, so a line that every document has is one row a task. Only
documents with a common line are then joined with their list of common
hashes; a fixed-size bitmap over document keys tells the others apart,
whose text is neither shuffled nor split.

Defined cases: a null text is empty, an empty text is one empty line; lines
whose key is empty always stay; very long texts are split whole, and every
line is looked up in a set; repeated rows count as documents of their
own; null ids are allowed; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from sightline.llm.common import BLANK, map_columns, sieve, sift
from sightline.session import materialize

#: The letters that the key lower-cases.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
_BLANK, _MASK = BLANK.encode(), (1 << 64) - 1


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hash(line: Column) -> Column:
    """128-bit hash of a line's key, as the text of two longs; null if the
    key is empty. A text, because sets of texts are hashed in Spark and sets
    of structs are not."""
    key = F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)
    return F.when(key != "", F.concat_ws(",", F.xxhash64(key).cast("string"), F.xxhash64(F.lit(1), key).cast("string")))


def _hashes(text: Column) -> Column:
    return F.array_distinct(F.array_compact(F.transform(lines_of(text), line_hash)))


class LineRuns:
    """Levelled runs of (h1, h2, n) and the common keys found so far."""

    def __init__(self, min_docs: int, fanout: int = 2):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.common: list[DataFrame] = []

    def _store(self, counts: DataFrame, level: int) -> None:
        run = (counts.repartition("h1", "h2").sortWithinPartitions("h1", "h2")
               .transform(lambda d: materialize(d, f"run{level}")))
        self.common.append(run.where(F.col("n") >= self.min_docs).select("h1", "h2"))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run.where(F.col("n") < self.min_docs))

    def known(self) -> DataFrame | None:
        out = None
        for c in self.common:
            out = c if out is None else out.unionByName(c)
        return out

    def add(self, keys: DataFrame) -> None:
        """A batch: one row (h1, h2) for each document and distinct key."""
        counts = keys.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
        known = self.known()
        if known is not None:
            counts = counts.join(known, ["h1", "h2"], "left_anti")
        self._store(counts, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._store(_merged(runs), level + 1)
            level += 1

    def finish(self) -> DataFrame:
        """The common keys, each once."""
        rest = [r for level in self.levels for r in level]
        if len(rest) > 1:
            total = _merged(rest).where(F.col("n") >= self.min_docs).select("h1", "h2")
            self.common.append(total)
        out = self.known()
        return out.distinct().transform(lambda d: materialize(d, "common"))


def _merged(runs: list[DataFrame]) -> DataFrame:
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out.groupBy("h1", "h2").agg(F.sum("n").alias("n"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
               batches: int = 3, fanout: int = 2, bits: int = 1 << 24) -> DataFrame:
    """One row per document: id, ``lines`` (count before), ``dropped``
    (count) and the ``kept_text``: its lines whose key fewer than
    ``min_docs`` documents have, joined by newlines."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.withColumn("k", F.xxhash64("id", "t"))
    # one scan writes the narrow line table, one folder a batch
    from sightline.session import scratch_path
    import uuid
    where = scratch_path(spark, f"tables/lines-{uuid.uuid4().hex}")
    (rows.select("k", F.explode(_hashes(F.col("t"))).alias("h"))
     .select("k", F.substring_index("h", ",", 1).cast("long").alias("h1"),
             F.substring_index("h", ",", -1).cast("long").alias("h2"), F.pmod(F.xxhash64(F.lit(2), "k"), F.lit(batches)).cast("int").alias("batch"))
     .write.partitionBy("batch").parquet(where))
    lines = spark.read.schema("k long, h1 long, h2 long, batch int").parquet(where)
    runs = LineRuns(min_docs, fanout)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b).select("h1", "h2"))
    common = runs.finish()
    # the common hashes of each document that has any; few and bounded by its own lines
    hits = (lines.select("k", "h1", "h2").join(common, ["h1", "h2"])
            .groupBy("k").agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))
            .transform(lambda d: materialize(d, "hits")))
    maybe, sure = sift(rows, "k", sieve(hits, "k", bits), bits)
    # documents under one key hold only keys that are common everywhere, so
    # the union of their hashes is right for each of them
    hit = maybe.join(hits, "k", "left").select(
        "id", "t", F.transform("gone", lambda g: g["h1"]).alias("g1"), F.transform("gone", lambda g: g["h2"]).alias("g2"))
    second = spark.range(1).select(F.xxhash64(F.lit(1))).first()[0] & _MASK
    kept = map_columns(hit, lambda _state, *cols: _kept(second, *cols), ["t", "g1", "g2"],
                       [StructField("stay", LongType()), StructField("kept", StringType())], keep=["id", "t"])
    n = F.size(lines_of(F.col("t"))).cast("long")
    whole = sure.select("id", n.alias("lines"), F.lit(0).cast("long").alias("dropped"), F.col("t").alias("kept_text"))
    cut = kept.select("id", n.alias("lines"), (n - F.col("stay")).alias("dropped"), F.col("kept").alias("kept_text"))
    return whole.unionByName(cut).withColumnRenamed("id", id_col)


def _kept(second: int, texts: pa.Array, g1: pa.Array, g2: pa.Array) -> list:
    """(lines that stay, their text) of each text, given the hashes of its
    common lines; one look into a set a line."""
    stay, out = [], []
    for text, one, two in zip(texts.to_pylist(), g1.to_pylist(), g2.to_pylist()):
        lines = text.split("\n")
        if one:
            gone = {(a & _MASK, b & _MASK) for a, b in zip(one, two)}
            keys = (line.encode("utf-8").strip(_BLANK).lower() for line in lines)
            lines = [line for line, key in zip(lines, keys) if not key or (
                xxhash.xxh64_intdigest(key, 42), xxhash.xxh64_intdigest(key, second)) not in gone]
        stay.append(len(lines))
        out.append("\n".join(lines))
    return [stay, out]
