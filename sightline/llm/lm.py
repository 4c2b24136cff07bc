"""Language-model scoring by masked pseudo-likelihood.

Every token of a text is predicted from the tokens on both sides of it, the
token itself masked: log P(t | two left, two right). The sum over the text
is its score. Tokens are the pieces of a public BPE vocabulary, so every
word of any text is made of them, each with a probability of its own.

Network, in numpy: one embedding of each token, a weight of each of its
components for each of the four places of the window, their sum through tanh to a hidden layer, and a softmax
over all tokens in three steps: a tree of three levels with the cube root of
the vocabulary as its fan-out, its leaves in the order of the tokens' counts.
So a prediction costs three times the cube root of the vocabulary, not the
vocabulary. The biases of the tree begin at the exact counts over the whole
corpus, so training begins at the tokens' frequencies. Texts are worked on as
one sequence: an embedding is read once for the four windows that it is in,
and the layers lie in memory as the products read them.

Training covers every token of every document. One scan writes the tokens of
every row; they are dealt evenly to trainers of about ``per_trainer`` tokens
each, a row at a time in turn, so no hot source, language or group of copies
shapes a trainer. A trainer fits a copy by Adagrad: the nodes of the tree take
their rows of a buffer in small steps, then the embeddings. The copies are
averaged, weighted by their tokens, in a tree over slices of the parameters,
so neither a task nor the driver holds more than a bounded share of them. The
number of copies, that is, what is gathered, grows with the corpus. The
network that is broadcast for scoring has a fixed size (the vocabulary's).

Defined cases: a null or blank text has no tokens, score 0 and a null mean;
ties in the counts go to the smaller id; repeated rows count as often as they
occur and get scores that are equal up to single precision; very long texts are encoded and scored whole
(in training, a text longer than a buffer is cut there, and the tokens beside
a cut see an end);
extra columns are ignored or kept whatever their names (a new column whose
name is taken gets underscores in front); an empty corpus gives the untrained
network and an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField

from sightline.llm import bpe, packing
from sightline.llm.common import fresh, map_columns
from sightline.session import materialize

PLACES = (-2, -1, 1, 2)
REACH = max(PLACES)
#: Rows of the sequence that are worked on at once, so that they stay in the processor's cache.
_ROWS = 4096
#: How the tokens of a row are written.
_IDS = np.dtype("<u2")


@dataclass(frozen=True)
class Shape:
    """Sizes of the network: ``tokens`` in all, ``fan`` to the third leaves."""
    tokens: int
    hidden: int = 16

    @property
    def fan(self) -> int:
        k = 1
        while k ** 3 < self.tokens:
            k += 1
        return k


def joined(texts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(all texts in one sequence, with ``pad`` at every end as far as a
    window reaches; the places of their tokens in it)."""
    gap = np.full(REACH, pad, dtype=np.int32)
    flat = np.concatenate([x for t in texts for x in (gap, t)] + [gap]).astype(np.int32, copy=False)
    return flat, np.flatnonzero(flat != pad)


def windows(texts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, contexts (n, 4)) of all texts; places beyond an end hold
    ``pad``."""
    flat, at = joined(texts, pad)
    return flat[at], np.stack([flat[at + p] for p in PLACES], axis=1)


def _apart(token: np.ndarray, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same as ``joined`` of windows that are given one by one."""
    flat = np.insert(ctx, REACH, token, axis=1).astype(np.int32).ravel()
    return flat, np.arange(REACH, len(flat), 2 * REACH + 1)


class Network:
    """Parameters as one flat vector, so copies are averaged slice by slice.
    ``leaf`` is the place of each token among the leaves."""

    def __init__(self, shape: Shape, leaf: np.ndarray | None = None, flat: np.ndarray | None = None, seed: int = 5):
        self.shape, h, k = shape, shape.hidden, shape.fan
        self.leaf = np.arange(shape.tokens) if leaf is None else leaf
        sizes = [(shape.tokens + 1, h), (len(PLACES), h), (h,), (1, k, h + 1), (k, k, h + 1), (k * k, k, h + 1)]
        total = sum(int(np.prod(x)) for x in sizes)
        if flat is None:
            flat = np.zeros(total, dtype=np.float32)
            n = int(np.prod(sizes[0])) + int(np.prod(sizes[1]))
            flat[:n] = np.random.default_rng(seed).standard_normal(n).astype(np.float32) * 0.2
            flat[int(np.prod(sizes[0])):n] *= 5.0
        self.flat, parts, at = flat, [], 0
        for x in sizes:
            n = int(np.prod(x))
            parts.append(flat[at:at + n].reshape(x))
            at += n
        self.embed, self.place, self.bias = parts[:3]
        #: (nodes, branches, hidden and 1) of each level, the bias beside its weights
        self.tree = parts[3:]
        #: (weights (nodes, hidden, branches), biases) of the nodes of each level
        self.levels = [(x[:, :, :h].transpose(0, 2, 1), x[:, :, h]) for x in self.tree]

    def begin_at(self, counts: np.ndarray) -> Network:
        """Biases that give every token its frequency, one more each; the
        leaves that no token has get nothing."""
        k = self.shape.fan
        n = np.full(k ** 3, 1e-9)
        n[self.leaf] = counts + 1.0
        n = n.reshape(k, k, k)
        two, one = n.sum(axis=2), n.sum(axis=(1, 2))
        self.levels[0][1][:] = np.log(one / one.sum())
        self.levels[1][1][:] = np.log(two / one[:, None])
        self.levels[2][1][:] = np.log(n / two[:, :, None]).reshape(k * k, k)
        return self

    def _kernel(self) -> np.ndarray:
        """(hidden, width of a window): what a component's weights are at each
        place of the window, none at its middle."""
        out = np.zeros((self.shape.hidden, 2 * REACH + 1), dtype=np.float32)
        out[:, [REACH + p for p in PLACES]] = self.place.T
        return out

    def hidden(self, flat: np.ndarray) -> np.ndarray:
        """The hidden layer (a row a component) at every token of a sequence
        but those without a whole window, and a row of 1 for the biases. A
        token's embedding is read once for all its windows."""
        n = max(0, len(flat) - 2 * REACH)
        out = np.ones((self.shape.hidden + 1, n), dtype=np.float32)
        kernel = self._kernel()
        for a in range(0, n, _ROWS):
            x = self.embed.take(flat[a:a + _ROWS + 2 * REACH], axis=0)
            h = out[:-1, a:a + _ROWS]
            for c, k in enumerate(kernel):
                h[c] = np.correlate(x[:, c], k)
            h += self.bias[:, None]
            np.tanh(h, out=h)
        return out

    def _leaves(self, token: np.ndarray) -> np.ndarray:
        return self.leaf.take(token).astype(np.uint16 if self.shape.fan ** 3 <= 1 << 16 else np.int64)

    def _level(self, leaf: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(the node of the level on the way to each leaf, the branch there)."""
        down = self.shape.fan ** (2 - level)
        node, branch = leaf // (down * self.shape.fan), leaf // down if level < 2 else leaf
        return node, (branch - node * self.shape.fan).astype(np.intp)

    def log_prob(self, token: np.ndarray, ctx: np.ndarray, most: int = 1 << 17) -> np.ndarray:
        """log P of every token given its context."""
        return self.log_prob_at(*_apart(token, ctx), most)

    def log_prob_at(self, flat: np.ndarray, at: np.ndarray, most: int = 1 << 17) -> np.ndarray:
        """log P of the tokens at the places ``at`` (ascending) of a sequence."""
        out, k = np.zeros(len(at)), self.shape.fan
        ones, every, work = np.ones(k, dtype=np.float32), np.arange(1024), np.empty(k * 1024, dtype=np.float32)
        for a in range(0, len(at), most):
            own = at[a:a + most]
            low = own[0] - REACH
            leaf = self._leaves(flat[own])
            order = np.argsort(leaf, kind="stable")
            leaf = leaf[order]
            h = self.hidden(flat[low:own[-1] + REACH + 1]).take(own[order] - own[0], axis=1)
            lp, sums = np.zeros(len(own)), np.empty((len(self.tree), len(own)), dtype=np.float32)
            for level, weights in enumerate(self.tree):
                node, branch = self._level(leaf, level)
                for i, j in _runs(node):
                    w = weights[node[i]]
                    for f in range(i, j, 1024):
                        t = min(f + 1024, j)
                        x = work[:k * (t - f)].reshape(k, t - f)
                        np.matmul(w, h[:, f:t], out=x)
                        lp[f:t] += x.ravel().take(branch[f:t] * (t - f) + every[:t - f])
                        np.exp(x, out=x)
                        np.matmul(ones, x, out=sums[level, f:t])
            out[a + order] = lp - np.log(sums, out=sums).sum(axis=0)
        return out

    def train(self, token: np.ndarray, ctx: np.ndarray, seen: Network, rate: float, step: int) -> None:
        """``train_at`` with windows that are given one by one."""
        self.train_at(*_apart(token, ctx), seen, rate, step)

    def train_at(self, flat: np.ndarray, at: np.ndarray, seen: Network, rate: float, step: int) -> None:
        """One buffer, the tokens at the places ``at`` of a sequence: every
        node of the tree takes its rows in steps of about ``step`` by Adagrad,
        each step dealt over all branches, then the embeddings take all
        in steps of eight times that. ``seen`` holds the sums of
        squares."""
        k, n, width = self.shape.fan, len(at), self.shape.hidden
        leaf, h = self._leaves(flat[at]), self.hidden(flat).take(at - REACH, axis=1)
        dh, back = np.zeros((n, width + 1), dtype=np.float32), np.empty(n, dtype=np.int64)
        ones, every, work = np.ones(max(k, 8 * step), dtype=np.float32), np.arange(step), np.empty(k * step, dtype=np.float32)
        order = np.argsort(leaf, kind="stable")
        for level, weights in enumerate(self.tree):
            runs = _runs(self._level(leaf[order], level)[0])
            by = order.copy()  # the rows of a step next to each other
            for i, j in runs:
                if j - i > step:
                    deal = -(-(j - i) // step)
                    by[i:j] = np.concatenate([order[i + a:j:deal] for a in range(deal)])
            node, branch = self._level(leaf[by], level)
            hs, ds = h.take(by, axis=1), np.empty_like(dh)
            for i, j in runs:
                w, sw, deal, f = weights[node[i]], seen.tree[level][node[i]], -(-(j - i) // step), i
                for a in range(deal):
                    t = f + len(range(i + a, j, deal))
                    x, d = hs[:, f:t], work[:k * (t - f)].reshape(k, t - f)
                    np.matmul(w, x, out=d)
                    np.exp(d, out=d)
                    d *= 1.0 / (ones[:k] @ d)
                    d.ravel()[branch[f:t] * (t - f) + every[:t - f]] -= 1.0
                    np.matmul(d.T, w, out=ds[f:t])
                    _update(w, sw, d @ x.T, rate)
                    f = t
            back[by] = np.arange(n)
            for a in range(0, n, _ROWS):
                dh[a:a + _ROWS] += ds.take(back[a:a + _ROWS], axis=0)
        slope = np.empty((n, width), dtype=np.float32)
        for a in range(0, n, _ROWS):
            x = h[:width, a:a + _ROWS]
            x = np.subtract(1.0, np.multiply(x, x, out=x), out=x)
            np.multiply(dh[a:a + _ROWS, :width], x.T, out=slope[a:a + x.shape[1]])
        deal = -(-n // (8 * step))
        for a in range(deal):
            rows = order[a::deal]
            m, d = len(rows), slope.take(rows, axis=0)
            ids = np.stack([flat[at[rows] + p] for p in PLACES])
            grads = np.repeat(self.place[:, None], m, axis=1)
            grads *= d
            _update(self.bias, seen.bias, ones[:m] @ d, rate)
            places = [ones[:m] @ (self.embed.take(x, axis=0) * d) for x in ids]
            _update(self.place, seen.place, np.stack(places), rate)
            ids = ids.ravel()
            by = np.argsort(ids.astype(np.uint16) if self.shape.tokens < 1 << 16 else ids, kind="stable")
            ids = ids[by]
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            grad = np.add.reduceat(grads.reshape(-1, width).take(by, axis=0), first, axis=0)
            own = ids[first]
            par, sq = self.embed.take(own, axis=0), seen.embed.take(own, axis=0)
            _update(par, sq, grad, rate)
            self.embed[own], seen.embed[own] = par, sq


def _update(par: np.ndarray, seen: np.ndarray, grad: np.ndarray, rate: float) -> None:
    x = grad * grad
    seen += x
    np.add(seen, 1e-6, out=x)
    np.sqrt(x, out=x)
    np.divide(grad, x, out=x)
    x *= rate
    par -= x


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the runs of equal values."""
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])).tolist()
    return list(zip(first, [*first[1:], len(x)]))


def tokenized(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None,
              ids_col: str = "token_ids", n_col: str = "n_tokens") -> tuple[DataFrame, str, str]:
    """(written table of the ``keep`` columns (all by default), the packed
    tokens of the whole text and their number; the names of these two)."""
    if vocabulary_size(path) >= 1 << 16:
        raise ValueError("the vocabulary does not fit into 16 bits")
    keep = list(docs.columns) if keep is None else keep
    n_col = fresh(n_col, keep)
    ids_col = fresh(ids_col, [*keep, n_col])

    def batch(encoder: packing.Encoder, texts: pa.Array) -> list:
        ids = list(encoder.encode(texts.to_pylist()))
        return [[len(x) for x in ids], [x.astype(_IDS).tobytes() for x in ids]]
    rows = map_columns(docs, batch, [text_col], [StructField(n_col, LongType()), StructField(ids_col, BinaryType())],
                       keep, setup=lambda: packing.encoder(path, 500_000), rows=1024)
    return materialize(rows, "lm-tokens"), ids_col, n_col


def vocabulary_size(path: str) -> int:
    return len(bpe.model(path).token_list)


def token_counts(rows: DataFrame, ids_col: str, size: int) -> np.ndarray:
    """How often each token occurs in all rows; added up in each task first,
    so ``size`` numbers a task at most are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, dtype=np.int64)
        for b in batches:
            sums += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), _IDS), minlength=size)
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own])], names=["token", "n"])
    out = np.zeros(size, dtype=np.int64)
    for r in (rows.select(ids_col).where(F.length(ids_col) > 0).mapInArrow(run, "token long, n long")
              .groupBy("token").agg(F.sum("n").alias("n")).collect()):
        out[r["token"]] = r["n"]
    return out


def _average(df: DataFrame, by: list[str]) -> DataFrame:
    """Weighted mean of the slices that share ``by``."""
    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        n = rows["n"].to_numpy(dtype=np.float64)
        total = sum(np.frombuffer(v, dtype=np.float32).astype(np.float64) * x for v, x in zip(rows["part"], n))
        first = rows.iloc[[0]].copy()
        first["part"] = [(total / max(n.sum(), 1.0)).astype(np.float32).tobytes()]
        first["n"] = int(n.sum())
        return first
    return df.groupBy(*by).applyInPandas(mean, df.schema)


def fit(rows: DataFrame, ids_col: str, size: int, hidden: int = 16, rate: float = 0.1, step: int = 1024,
        buffer: int = 1 << 16, per_trainer: int = 1 << 23, slice_of: int = 1 << 15, fan_in: int = 32) -> Network:
    """The network of a written table of tokens."""
    from pyspark import TaskContext
    shape = Shape(size, hidden)
    counts = token_counts(rows, ids_col, size)
    leaf = np.empty(size, dtype=np.int64)
    leaf[np.lexsort((np.arange(size), -counts))] = np.arange(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(shape, leaf).begin_at(counts)
        seen = Network(shape, leaf, np.zeros_like(net.flat))
        n, wait, held = 0, [], 0
        for batch in batches:
            for x in batch.column(0):
                ids = np.frombuffer(x.as_py(), _IDS)
                for a in range(0, len(ids), buffer):
                    wait.append(ids[a:a + buffer])
                    held += len(wait[-1])
                    if held >= buffer:
                        net.train_at(*joined(wait, size), seen, rate, step)
                        n, wait, held = n + held, [], 0
        if held:
            net.train_at(*joined(wait, size), seen, rate, step)
            n += held
        if n:
            ctx = TaskContext.get()
            task = ctx.partitionId() if ctx else 0
            parts = [net.flat[a:a + slice_of].tobytes() for a in range(0, len(net.flat), slice_of)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * len(parts), type=pa.int64()), pa.array(range(len(parts)), type=pa.int64()),
                 pa.array([n] * len(parts), type=pa.int64()), pa.array(parts, type=pa.binary())],
                names=["task", "slice", "n", "part"])
    trainers = max(1, -(-int(counts.sum()) // per_trainer))
    copies = (rows.select(ids_col).where(F.length(ids_col) > 0).repartition(trainers)
              .mapInArrow(run, "task long, slice long, n long, part binary")
              .transform(lambda d: materialize(d, "lm-copies")))
    while trainers > 1:
        copies = _average(copies.withColumn("task", F.expr(f"task div {fan_in}")), ["task", "slice"])
        trainers = -(-trainers // fan_in)
    got = copies.orderBy("slice").collect()  # one network
    if not got:
        return Network(shape, leaf).begin_at(counts)
    return Network(shape, leaf, np.frombuffer(b"".join(bytes(r["part"]) for r in got), dtype=np.float32).copy())


def train(docs: DataFrame, path: str, text_col: str = "text", **how) -> Network:
    """The network of the corpus; ``how`` are the options of ``fit``."""
    rows, ids, _ = tokenized(docs, path, text_col, keep=[])
    return fit(rows, ids, vocabulary_size(path), **how)


def _scored(rows: DataFrame, net: Network, ids_col: str, n_col: str, keep: list[str]) -> DataFrame:
    shape, leaf, flat = net.shape, net.leaf, net.flat
    log_prob, mean = (fresh(c, [*keep, n_col]) for c in ("log_prob", "mean_log_prob"))

    def batch(model: Network, packed: pa.Array) -> list:
        ids = [np.frombuffer(x, _IDS) for x in packed.to_pylist()]
        n = np.array([len(x) for x in ids], dtype=np.int64)
        total = np.zeros(len(ids))
        if n.sum():
            lp = model.log_prob_at(*joined(ids, shape.tokens))
            has = np.flatnonzero(n)
            total[has] = np.add.reduceat(lp, (np.cumsum(n) - n)[has])
        return [total]
    out = map_columns(rows, batch, [ids_col], [StructField(log_prob, DoubleType())], [*keep, n_col],
                      setup=lambda: Network(shape, leaf, flat))
    return out.select("*", F.when(F.col(n_col) > 0, F.col(log_prob) / F.col(n_col)).alias(mean))


def score(docs: DataFrame, net: Network, path: str, text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default), the tokens of the text, the sum of
    their conditional log-probabilities and its mean."""
    keep = list(docs.columns) if keep is None else keep
    rows, ids, n = tokenized(docs, path, text_col, keep)
    return _scored(rows, net, ids, n, keep)


def score_corpus(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None,
                 **how) -> DataFrame:
    """``score`` of all rows by the network of all rows; the texts are read
    and encoded once."""
    keep = list(docs.columns) if keep is None else keep
    rows, ids, n = tokenized(docs, path, text_col, keep)
    return _scored(rows, fit(rows, ids, vocabulary_size(path), **how), ids, n, keep)
