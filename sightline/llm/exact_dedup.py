"""Exact dedup by progressive refinement.

Texts are equal when they are identical after deleting white space. The
groups are refined in three steps, each on the survivors of the one before:

1. rows that share the length of the normalised text;
2. of those, rows that share a hash of its first ``prefix`` characters;
3. of those, rows that share SHA-256 of the whole normalised text.

Steps 1 and 2 work on a narrow table (a key, a length, a hash) that one scan
writes: the counts are pre-aggregated, and a bitmap of fixed size tells
which rows survive without moving them. Step 3 scans the texts again and
hashes only rows that the bitmap of the survivors lets through; bitmaps may
let too many through, so this step alone decides. The rows are joined with
their groups by a plain equi-join, which Spark splits when a text is very
common. The text itself is never shuffled, and nothing is collected.

Defined cases: a null text is an empty one, and empty texts are equal to
each other; a null id sorts after all others; rows that repeat an id are
rows of one document and share its verdict. Other columns are ignored
whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import BLANK_CLASS, fresh, sieve, sift, without_keys
from sightline.session import materialize


def normalised(text: Column) -> Column:
    """The text (null: empty) without any white space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_CLASS, "")


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64) -> DataFrame:
    """One narrow row per document: key, id, code points of the text, length
    and prefix hash of the normalised text."""
    return (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
            .select(F.xxhash64("id", "t").alias("k"), "id", F.char_length("t").cast("long").alias("n_points"),
                    normalised(F.col("t")).alias("norm"))
            .select("k", "id", "n_points", F.char_length("norm").alias("len"),
                    F.xxhash64(F.substring("norm", 1, prefix)).alias("head")))


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64,
              bits: int = 1 << 24) -> DataFrame:
    """Keys ``k`` of the documents that may share length and prefix hash
    with another one: only their full content needs reading. Shared lengths,
    then shared prefixes, go into bitmaps, which pass the rows in place: no
    row moves to where its length is counted, however common that is."""
    sig = signatures(docs, id_col, text_col, prefix).select("k", "len", "head").transform(materialize)

    def shared(rows: DataFrame, *by: str) -> DataFrame:
        many = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        key = F.xxhash64(*by)
        return sift(rows.withColumn("by", key), "by", sieve(many.select(key.alias("by")), "by", bits), bits)[0]
    return shared(shared(sig, "len"), "len", "head").select("k")


def full_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64,
                bits: int = 1 << 24) -> DataFrame:
    """(id, k, n_points, sha) of the documents that survive the first two
    steps (and the few that the bitmap cannot tell from them)."""
    keyed = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    keyed = keyed.withColumn("k", F.xxhash64("id", "t"))
    left, _ = sift(keyed, "k", sieve(survivors(docs, id_col, text_col, prefix, bits), "k", bits), bits)
    return left.select("id", "k", F.char_length("t").cast("long").alias("n_points"),
                       F.sha2(normalised(F.col("t")), 256).alias("sha"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64,
                     bits: int = 1 << 24) -> DataFrame:
    """(sha, keep_id, group_size) of every text that several rows have. The
    row with the most code points in its original text, then the least id,
    is the one to keep."""
    return _groups(full_hashes(docs, id_col, text_col, prefix, bits))


def _groups(h: DataFrame) -> DataFrame:
    order = F.struct(-F.col("n_points"), F.col("id").isNull(), F.col("id"))
    return (h.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"),
                                 F.min(order).getField("id").alias("keep_id"))
            .where("group_size > 1").transform(materialize))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64,
                bits: int = 1 << 24) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept and the hash of
    its normalised text.

    The verdicts come from ``duplicate_groups``; the hash of documents that
    are alone is made here for the report only, on the scan that joins the
    narrow rows with the groups."""
    g = duplicate_groups(docs, id_col, text_col, prefix, bits)
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("sha"))
    return rows.join(g, "sha", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64,
                          bits: int = 1 << 24) -> DataFrame:
    """The input rows (all columns) without those whose text another row
    keeps. Only narrow rows of duplicated texts are joined; the texts stay
    where they are."""
    h = materialize(full_hashes(docs, id_col, text_col, prefix, bits), "full-hashes")
    gone = (h.join(_groups(h), "sha").where(~F.col("id").eqNullSafe(F.col("keep_id")))
            .select("k", "id").distinct().transform(materialize))
    key = fresh("row_key", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))))
    return without_keys(keyed, key, gone, "k", bits, same={id_col: "id"}).select(*docs.columns)
