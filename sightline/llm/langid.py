"""Language ID by string kernels.

Kernel: blended spectrum, presence only. A text is the set of its byte
n-grams of length 1 to 3 (lower-cased UTF-8) that belong to the vocabulary,
and the kernel of two texts is the size of the sets' intersection over the
geometric mean of their sizes. The vocabulary holds the n-grams that most
landmarks have.

Fit, on the driver: at most ``per_lang`` labelled rows of each language,
those with the smallest hash of their id (a documented bound: only the fit
is on a sample). The first ``landmarks`` of each language are the Nyström
landmarks; a text's features are its kernel with them, whitened. One ridge
regression for each language against the rest gives the weights.

Prediction: for a batch of texts, the presence matrix times the landmark
matrix gives the kernel, and the kernel times the folded weights gives the
scores of all languages. It runs where the scan put the texts, nothing is
shuffled.

Defined cases: ``und`` with score 0 for a null text or one without letters,
and for every text if nothing could be learned; a text with letters but
without any known n-gram gets the language with the largest intercept; ties
go to the language that sorts first; extra columns are ignored; repeated
rows are predicted alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField

from sightline.llm.common import map_columns, sieve, sift
from sightline.session import materialize

_LETTER = regex.compile(r"\p{L}")
_PAIRS, _TRIPLES = 256, 256 + 65536
_CODES = _TRIPLES + (1 << 24)


def ngrams(text: str) -> np.ndarray:
    """Codes of the byte n-grams of length 1 to 3, with repeats."""
    b = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.int32)
    two = (b[:-1] << 8) | b[1:]
    return np.concatenate([b, two + _PAIRS, ((two[:-1] << 8) | b[2:]) + _TRIPLES])


def has_letters(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


@dataclass
class LanguageModel:
    langs: list[str]
    codes: np.ndarray        # n-grams of the vocabulary
    landmarks: np.ndarray    # vocabulary x landmarks, scaled by 1/sqrt(set size)
    weights: np.ndarray      # landmarks x languages
    bias: np.ndarray

    def table(self) -> np.ndarray:
        place = np.zeros(_CODES, dtype=np.int16)
        place[self.codes] = np.arange(1, len(self.codes) + 1)
        return place

    def kernel(self, place: np.ndarray, texts: list[str]) -> np.ndarray:
        present = np.zeros((len(texts), len(self.codes) + 1), dtype=np.float32)
        for row, t in enumerate(texts):
            present[row, place[ngrams(t)]] = 1.0
        present = present[:, 1:]
        size = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1.0))
        return (present @ self.landmarks) / size

    def scores(self, place: np.ndarray, texts: list[str]) -> np.ndarray:
        return self.kernel(place, texts) @ self.weights + self.bias


def fit(sets: list[np.ndarray], langs: list[str], landmarks: int = 32, vocabulary: int = 4096,
        ridge: float = 1e-2) -> LanguageModel:
    """Model of the rows (set of n-gram codes, language), in this order."""
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs])
    marks = np.concatenate([np.flatnonzero(y == c)[:landmarks] for c in range(len(names))])
    codes, n = np.unique(np.concatenate([sets[i] for i in marks]), return_counts=True)
    codes = np.sort(codes[np.lexsort((codes, -n))[:vocabulary]])

    def presence(rows) -> np.ndarray:
        p = np.zeros((len(rows), len(codes)), dtype=np.float32)
        for r, i in enumerate(rows):
            at = np.searchsorted(codes, sets[i])
            at = at[(at < len(codes))]
            p[r, at[np.isin(codes[at], sets[i])]] = 1.0
        return p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1.0))
    z = presence(marks)
    k_mm = (z @ z.T).astype(np.float64)
    val, vec = np.linalg.eigh(k_mm)
    ok = val > 1e-6 * val.max()
    whiten = vec[:, ok] / np.sqrt(val[ok])
    phi = (presence(range(len(sets))) @ z.T).astype(np.float64) @ whiten
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    mean_phi, mean_y = phi.mean(axis=0), target.mean(axis=0)
    c = phi - mean_phi
    w = np.linalg.solve(c.T @ c + ridge * len(sets) * np.eye(c.shape[1]), c.T @ (target - mean_y))
    return LanguageModel(names, codes.astype(np.int64), np.ascontiguousarray(z.T),
                         (whiten @ w).astype(np.float32), (mean_y - mean_phi @ w).astype(np.float32))


def held_out(id_col: str = "doc_id", rest: int = 2, mod: int = 4) -> Column:
    """crc32 of the id as text leaves ``rest`` modulo ``mod``."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(mod)) == rest, F.lit(False))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = 400, landmarks: int = 32, vocabulary: int = 4096) -> LanguageModel | None:
    """Model of the rows of ``labelled``; the caller leaves out what is held
    back. None if no row has a language and letters."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))
    rows = rows.where("lang is not null and t rlike '\\\\p{L}'").withColumn("k", F.xxhash64("id", "t"))
    keys = rows.select("lang", "k").transform(lambda d: materialize(d, "lang-keys"))
    # common languages (at most 1,000 have many rows to spare) are thinned by
    # their rows' hash to about four times what is wanted, in place, so none
    # costs the ranking more than that
    common = (keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 16 * per_lang)
              .orderBy(F.col("n").desc(), "lang").limit(1000).collect())
    place = F.pmod(F.xxhash64(F.lit(1), "k"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = keys
    if common:
        n_of = F.create_map(*[x for r in common for x in (F.lit(r["lang"]), F.lit(r["n"]))])
        few = keys.where(place * F.coalesce(F.try_element_at(n_of, F.col("lang")), F.lit(0)) < 4 * per_lang)
    first = Window.partitionBy("lang").orderBy(place, "k")
    picks = (few.withColumn("place", F.row_number().over(first))
             .where(F.col("place") <= per_lang).select("k").distinct()
             .transform(lambda d: materialize(d, "lang-sample")))
    maybe, _ = sift(rows, "k", sieve(picks, "k"))

    def batch(_state, t: pa.Array) -> list:
        return [[np.unique(ngrams(x)) for x in t.to_pylist()]]
    got = map_columns(maybe.join(picks, "k"), batch, ["t"], [StructField("codes", ArrayType(IntegerType()))],
                      keep=["lang", "k"]).toArrow().sort_by([("lang", "ascending"), ("k", "ascending")])
    if not got.num_rows:
        return None
    sets = [np.array(x, dtype=np.int64) for x in got["codes"].to_pylist()]
    return fit(sets, got["lang"].to_pylist(), landmarks, vocabulary)


def predict(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus language and score."""
    def batch(place, t: pa.Array) -> list:
        texts = t.to_pylist()
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        at = [i for i, x in enumerate(texts) if has_letters(x)] if model is not None else []
        if at:
            s = model.scores(place, [texts[i] for i in at])
            best = s.argmax(axis=1)
            for i, b, v in zip(at, best.tolist(), s[np.arange(len(at)), best].tolist()):
                lang[i], score[i] = model.langs[b], min(1.0, max(0.0, (v + 1.0) / 2.0))
        return [lang, score]
    return map_columns(docs, batch, [text_col], [StructField(lang_out, StringType()),
                                                 StructField(score_out, DoubleType())], keep,
                       setup=(lambda: model.table()) if model is not None else None, rows=128)
