"""One contract query for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from sightline.llm import ann, bpe, codes, exact_dedup, langid, line_dedup, lm, mixing, packing, pii, quality, simhash, trie
from sightline.llm.common import map_columns, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_exact_dedup", oracle=r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n_points,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
     r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS place,
                  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM n),
     k AS (SELECT text_sha256, doc_id AS keep_id FROM r WHERE place = 1)
SELECT r.doc_id, k.keep_id, r.group_size, r.doc_id = k.keep_id AS kept, r.text_sha256
FROM r JOIN k USING (text_sha256)
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 1 over all documents."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 2 over all documents: ids, decoded text, and their digests."""
    path = tokenizer_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, path, keep=["doc_id"])
    both = bpe.decode(ids, path)

    def digest(_state, ids: pa.Array) -> list:
        flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        ends = ids.offsets.to_numpy()
        return [[hashlib.sha256(np.ascontiguousarray(flat[a:b]).tobytes()).hexdigest()
                 for a, b in zip(ends[:-1], ends[1:])]]
    out = map_columns(both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                                  F.sha2("decoded", 256).alias("decoded_sha256")),
                      digest, ["ids"], [StructField("ids_sha256", StringType())],
                      keep=["doc_id", "n_tokens", "decoded_sha256"])
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 4 over all documents: 3-word shingles, links at 3 bits or fewer."""
    return simhash.simhash_near_dedup(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


@query("op5_line_dedup", oracle=r"""
WITH l AS (SELECT rowid_ AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
           FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)),
     k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY k.r, k.doc_id
""")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 5 over all documents: lines of 10 or more documents go."""
    d = line_dedup.line_dedup(table(spark, sf_dir, "documents"), min_docs=10)
    return d.select("doc_id", F.col("lines").alias("n_lines"), F.col("dropped").alias("n_dropped"),
                    F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 8 over all documents: weights 1, 2, 3 by source, 3 times at most."""
    m = mixing.mix_to_targets(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                    "copies")


@query("op3_ann")
def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 3: the 5 nearest of all vectors for every id that 50 divides."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op6_langid")
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 6 over all documents; a quarter of the ids is held out of the fit."""
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out("doc_id")
    m = langid.train(docs.where(~out))
    p = langid.predict(docs.select("doc_id", "text"), m, keep=["doc_id"])
    return p.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query("op7_lm_scoring")
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 7: trained on all documents, scores all documents."""
    return lm.score_corpus(table(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"])


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 9 over all documents; a third of the ids is held out of the fit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.held_out("doc_id")
    m = quality.train(docs, table(spark, sf_dir, "labels").where(~out))
    s = quality.score(docs, m, keep=["doc_id"])
    return s.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 10 over all documents. Counts and digest are those of the rules'
    spans; ``spans`` holds the added ones too."""
    p = pii.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [pii.n_spans(F.col("seeds"), k).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return p.select("doc_id", *counts, F.sha2(pii.spans_text(F.col("seeds")), 256).alias("base_sha256"),
                    pii.spans_text(F.col("spans")).alias("spans"))


@query("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 11 over all documents: sequences of 4,096 tokens, id 1 ends a document."""
    p = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096, end_id=1)
    return p.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op12_trie", oracle=r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
             PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
     v AS (SELECT c, CAST(c AS VARCHAR) AS s FROM t GROUP BY c),
     crc AS (SELECT c, xor(4294967295, list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length(s) + 1),
                 lambda k: [CAST(ord(s[k]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) AS crc
             FROM v),
     h AS (SELECT c, c - c % 100 AS base, crc % 6 AS h FROM crc),
     r AS (SELECT h.c, t.i, t.role, t.text FROM h JOIN t ON t.c = h.base AND t.i <= h.h
           UNION ALL SELECT h.c, t.i, t.role, t.text FROM h JOIN t ON t.c = h.c AND t.i > h.h),
     q AS (SELECT v.c, coalesce(turns, []) AS turns FROM v LEFT JOIN (
             SELECT c, list({'role': role, 'text': text} ORDER BY i) AS turns FROM r GROUP BY c) USING (c)),
     d AS (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS depth FROM q),
     p AS (SELECT c, depth, depth = len(turns) AS ends, sha256(CAST(to_json(turns[1:depth]) AS VARCHAR)) AS k,
                  sha256(CAST(to_json(turns[1:depth - 1]) AS VARCHAR)) AS pk,
                  CASE WHEN depth = 0 THEN 0 ELSE length(turns[depth].text) END AS points FROM d),
     n AS (SELECT depth, k, min(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(points) AS saved,
                  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
           FROM p GROUP BY depth, k),
     ch AS (SELECT pk AS k, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
     m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (k, depth)),
     s AS (SELECT p.depth, p.k, sum(CASE WHEN m.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(m.saved) AS saved_tokens
           FROM m JOIN p ON p.c = m.conv_id AND p.depth <= m.depth GROUP BY p.depth, p.k)
SELECT m.conv_id, m.depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s USING (depth, k) LEFT JOIN n up ON m.depth > 0 AND up.depth = m.depth - 1 AND up.k = m.pk
""")
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 12 over all conversations."""
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """The rounds of op 13 written out."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
     a{r} AS (SELECT part, rid, arg_min(entry, d * {entries} + entry) AS entry, min(d) AS d, any_value(v) AS v FROM (
               SELECT x.part, x.rid, b.entry, x.v, list_sum(list_transform(list_zip(x.v, b.v),
                 lambda q: (q[1] - q[2]) * (q[1] - q[2])))::BIGINT AS d FROM x JOIN b{r} b USING (part)) GROUP BY part, rid)""")
        if r < rounds:
            steps.append(f"""
     u{r} AS (SELECT part, entry, list(m ORDER BY pos) AS v FROM (
               SELECT part, entry, pos, CAST(((sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*)) AS BIGINT) AS m
               FROM (SELECT part, entry, unnest(v) AS c, generate_subscripts(v, 1) AS pos FROM a{r}) GROUP BY part, entry, pos)
             GROUP BY part, entry),
     b{r + 1} AS (SELECT part, entry, coalesce(u{r}.v, b{r}.v) AS v FROM b{r} LEFT JOIN u{r} USING (part, entry))""")
    body = ",".join(steps)
    return f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rid, vec_id, label,
                  list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
     x AS (SELECT rid, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS v
           FROM k, range({parts}) t(part)),
     b0 AS (SELECT part, rid AS entry, v FROM x WHERE rid < {entries}),{body},
     e AS (SELECT rid, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
           FROM a{rounds} GROUP BY rid),
     s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN e USING (rid), s
"""


@query("op13_codes", oracle=_codes_sql())
def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 13 over all embeddings: 4 parts, 256 entries, 4 rounds."""
    found, books = codes.vector_codes(table(spark, sf_dir, "embeddings"), keep=["vec_id", "label"])
    d = codes.with_group_error(found, books, "label")
    return d.select("vec_id", "code", "error", F.col("group_error").alias("label_error"), "codebooks_sha256")
