"""Quality classifier: hashed word n-grams, logistic regression by FTRL.

Features. The words of the whole text are hashed one by one; n-grams of one
and two words, and of one to three word forms (letters, digits and marks
folded to their kind, with a sign for a word that repeats the one before),
are hashed into ``dim`` slots. A slot's value is its share of the text's
words, so length alone says nothing.

Training. The rows are labelled documents, at most ``per_class`` of each
label, those with the smallest hash of their id (a documented bound: only
the fit is on a sample). Weights restore the labels' shares. Updates follow
the regularised leader, coordinate by coordinate, on the driver: its memory
is bounded by the sample.

Scoring. A sparse dot product for each text, in Arrow batches where the scan
put them; nothing is shuffled.

Defined cases: a null or blank text has no words and gets the score of the
intercept; a null label or one other than 0 and 1 does not train; without
labels every score is 0.5; repeated label rows train as often as they occur;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField

from sightline.llm.common import fresh, map_columns

_KINDS = bytes((b if b < 128 else ord("a")) for b in range(256))
_KINDS = _KINDS.translate(bytes.maketrans(b"abcdefghijklmnopqrstuvwxyz", b"a" * 26))
_KINDS = _KINDS.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"A" * 26))
_KINDS = _KINDS.translate(bytes.maketrans(b"0123456789", b"9" * 10))
_RUNS = re.compile(rb"(.)\1+", re.S)
_WORDS_KEPT = 100_000
_M = np.uint64(0x9E3779B97F4A7C15)


class Hasher:
    """Slots of a text's n-grams, behind a bounded cache of words."""

    def __init__(self, dim: int):
        self.shift = np.uint64(64 - (dim.bit_length() - 1))
        self.seen: dict[bytes, int] = {}

    def _word(self, w: bytes) -> int:
        form = _RUNS.sub(rb"\1", w.translate(_KINDS))
        v = (zlib.crc32(w) << 32) | zlib.crc32(form)
        if len(w) <= 64:
            if len(self.seen) >= _WORDS_KEPT:
                self.seen.clear()
            self.seen[w] = v
        return v

    def slots(self, text: str | None) -> tuple[np.ndarray, int]:
        """(slots with repeats, number of words)."""
        words = (text or "").encode("utf-8", "surrogatepass").split()
        n = len(words)
        if not n:
            return np.empty(0, np.int64), 0
        got = [self.seen.get(w) for w in words]
        if None in got:
            got = [self._word(w) if v is None else v for w, v in zip(words, got)]
        v = np.array(got, dtype=np.uint64)
        word, form = v >> np.uint64(32), v & np.uint64(0xFFFFFFFF)
        form = form * np.uint64(2)
        form[1:] += word[1:] == word[:-1]
        with np.errstate(over="ignore"):
            grams = [word * np.uint64(8) + np.uint64(1),
                     (word[:-1] * np.uint64(0x100000001B3) + word[1:]) * np.uint64(8) + np.uint64(2),
                     form * np.uint64(8) + np.uint64(3),
                     (form[:-1] * np.uint64(0x100000001B3) + form[1:]) * np.uint64(8) + np.uint64(4),
                     ((form[:-2] * np.uint64(0x100000001B3) + form[1:-1]) * np.uint64(0x100000001B3) + form[2:])
                     * np.uint64(8) + np.uint64(5)]
            return ((np.concatenate(grams) * _M) >> self.shift).astype(np.int64), n


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float

    def score(self, hasher: Hasher, text: str | None) -> float:
        at, n = hasher.slots(text)
        x = self.bias + (float(self.weights[at].sum(dtype=np.float64)) / n if n else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(x, -500, 500))))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int, float]], dim: int, epochs: int = 5, alpha: float = 3.0,
         beta: float = 0.05, l1: float = 1e-5, l2: float = 1e-3, seed: int = 3) -> QualityModel:
    """Rows are (slots, values, label, weight); the intercept is added to
    each as the last coordinate. Each update adds the gradient and the shift of the proximal
    term to z, the square to n, for the row's coordinates only."""
    z, n = np.zeros(dim + 1), np.zeros(dim + 1)
    w = np.zeros(dim + 1)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            at, x, label, weight = rows[r]
            at, x = np.append(at, np.int32(dim)), np.append(x, np.float32(1.0))
            p = 1.0 / (1.0 + np.exp(-np.clip(w[at] @ x, -500, 500)))
            g = weight * (p - label) * x
            step = n[at] + g * g
            z[at] += g - (np.sqrt(step) - np.sqrt(n[at])) / alpha * w[at]
            n[at] = step
            zi = z[at]
            w[at] = np.where(np.abs(zi) <= l1, 0.0,
                             -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(step)) / alpha + l2))
    return QualityModel(w[:dim].astype(np.float32), float(w[dim]))


def held_out(id_col: str = "doc_id", rest: int = 1, mod: int = 3) -> Column:
    """crc32 of the id as text leaves ``rest`` modulo ``mod``."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(mod)) == rest, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_class: int = 3000, dim: int = 1 << 18, **options) -> QualityModel:
    """Model of the labelled documents. ``labels`` holds the rows that may
    train: the caller leaves out what is held back."""
    y = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(
        "y in (0, 1) and id is not null")
    shares = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shares:
        return QualityModel(np.zeros(dim, np.float32), 0.0)
    picks = None
    for c in sorted(shares):
        s = y.where(F.col("y") == c).orderBy(F.xxhash64("id"), "id").limit(per_class)
        picks = s if picks is None else picks.unionByName(s)
    # at most 2 x per_class rows: bounded, so they may be broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(picks), "id")

    def batch(h: Hasher, t: pa.Array) -> list:
        slots, values = [], []
        for text in t.to_pylist():
            at, n = h.slots(text)
            u, c = np.unique(at, return_counts=True)
            slots.append(u.astype(np.int32))
            values.append((c / max(n, 1)).astype(np.float32))
        return [slots, values]
    got = map_columns(texts, batch, ["t"], [StructField("slots", ArrayType(IntegerType())),
                                            StructField("values", ArrayType(FloatType()))],
                      keep=["id", "y"], setup=lambda: Hasher(dim)).toArrow().sort_by([("id", "ascending")])
    y_all = got["y"].to_numpy()
    n_of = {c: max(1, int((y_all == c).sum())) for c in shares}
    total = sum(shares.values())
    rows = []
    for part in got.select(["y", "slots", "values"]).to_batches():
        # views of the flat Arrow buffers: neither copies nor Python numbers
        ends = part.column(1).offsets.to_numpy()
        at, x = part.column(1).values.to_numpy(), part.column(2).values.to_numpy()
        for c, a, b in zip(part.column(0).to_pylist(), ends[:-1], ends[1:]):
            rows.append((at[a:b], x[a:b], c, shares[c] / total * len(y_all) / n_of[c]))
    return ftrl(rows, dim, **options)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out_col: str = "score",
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus the score of the text."""
    dim = len(model.weights)

    def batch(h: Hasher, t: pa.Array) -> list:
        return [[model.score(h, text) for text in t.to_pylist()]]
    return map_columns(docs, batch, [text_col], [StructField(out_col, DoubleType())], keep,
                       setup=lambda: Hasher(dim))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = 0.5, **options) -> DataFrame:
    """The input rows (all columns) that score ``threshold`` or more."""
    s = fresh("quality_score", docs.columns)
    m = train(docs, labels, id_col, text_col, **options)
    return score(docs, m, text_col, s).where(F.col(s) >= threshold).select(*docs.columns)
