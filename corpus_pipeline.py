"""The corpus pipeline: five stages over documents, each one of the ten
operators applied to all that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir)
and returns a DataFrame. All but the last return the columns of their input.
``run`` writes every stage's rows as Parquet in the shared folder and reads
them back as the next stage's documents, so a lost executor repeats a stage
at most.

Defined cases: each stage takes null ids and texts, empty and very long
texts, repeated rows, empty tables and extra columns of any name; see the
operators for what they do with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sightline.llm import bpe, exact_dedup, mixing, quality, simhash
from sightline.llm.common import fresh, table
from sightline.llm.queries import tokenizer_path
from sightline.session import materialize


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Labels of every
    third id stay out of the fit, as in the operator's own query."""
    labels = table(spark, sf_dir, "labels").where(~quality.held_out("doc_id"))
    return quality.keep_good(docs, labels)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the least id."""
    return simhash.keep_one_of_each(docs, shingle=3, max_bits=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the text they decode to, beside the documents' columns
    (but for the text itself)."""
    path = tokenizer_path()
    ids, back = fresh("ids", docs.columns), fresh("decoded", docs.columns)
    encoded = bpe.encode(docs, path, out_col=ids, keep=[c for c in docs.columns if c != "text"])
    return bpe.decode(encoded, path, ids, back)


STAGES = [("quality classifier", quality_filter), ("exact dedup", exact), ("simhash near-dedup", near),
          ("mixing to target weights", mix), ("bpe encoding", encode)]

#: The classifier, the rounding and the merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "stage-" + name.replace(" ", "-"))
    return docs
