"""Language ID, quality and LM: held-out accuracy and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.llm import langid, lm, packing, quality
from sightline.llm.queries import tokenizer_path
from tests.conftest import SF_ORACLE
from tests.llm import brute


def test_langid_held_out(docs):
    out = langid.held_out("doc_id")
    m = langid.train(docs.where(~out))
    p = langid.predict(docs, m, keep=["doc_id", "lang"]).withColumn("out", out).collect()
    held = [r for r in p if r.out and r.lang is not None]
    assert all(r.out == (brute.part(r.doc_id, 4) == 2) for r in p)
    assert len(held) > 100
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in p)


def test_langid_odd(odd, empty):
    m = langid.train(odd)
    got = {(r.doc_id, r.lang_pred, r.score) for r in langid.predict(odd, m, score_out="p", keep=["doc_id"]).withColumnRenamed("p", "score").collect()}
    assert {(3, "und", 0.0), (4, "und", 0.0), (5, "und", 0.0)} <= got
    assert {x[1] for x in got} <= {"en", "de", "und"}
    assert langid.train(empty) is None
    assert langid.predict(empty, None, score_out="p").collect() == []
    assert {r.lang_pred for r in langid.predict(odd, None, score_out="p").collect()} == {"und"}


def test_langid_kernel_is_the_presence_kernel():
    """The scored kernel equals sets counted one by one."""
    texts = ["abcabd", "xyzxyz", "abx", "zzz"]
    sets = [np.unique(langid.ngrams(t)) for t in texts]
    m = langid.fit(sets, ["a", "b", "a", "b"], landmarks=2, vocabulary=1000)
    got = m.kernel(m.table(), ["abz"])[0]
    mine = set(langid.ngrams("abz").tolist()) & set(m.codes.tolist())
    order = [0, 2, 1, 3]
    want = [len(mine & set(sets[i].tolist())) / np.sqrt(len(mine) * len(sets[i])) for i in order]
    assert np.allclose(got, want, atol=1e-6)


def test_quality_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    out = quality.held_out("doc_id")
    m = quality.train(docs, labels.where(~out))
    rows = quality.score(docs, m, keep=["doc_id"]).join(labels, "doc_id").withColumn("out", out).collect()
    held = [r for r in rows if r.out]
    assert all(r.out == (brute.part(r.doc_id, 3) == 1) for r in rows)
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in held]) >= 0.97
    clean = [r for r in rows if r.quality == 1]
    assert np.mean([r.score >= 0.5 for r in clean]) >= 0.99


def test_quality_odd(spark, odd, empty):
    y = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 1), (None, 1, 0), (6, None, 0), (99, 1, 0), (8, 7, 0)],
                              "doc_id long, quality int, toxic int")
    m = quality.train(odd, y)
    out = quality.keep_good(odd, y)
    assert out.columns == odd.columns and out.count() <= odd.count()
    got = quality.score(odd, m, out_col="p", keep=["doc_id"]).collect()
    assert len(got) == odd.count() and all(0 <= r.p <= 1 for r in got)
    none = quality.train(odd, y.limit(0))
    assert {r.p for r in quality.score(odd, none, out_col="p").collect()} == {0.5}
    assert quality.keep_good(empty, y).collect() == []


def test_quality_fits_on_3000_rows_a_label(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "ftrl", lambda rows, dim, **o: seen.append(rows) or quality.QualityModel(np.zeros(dim), 0.0))
    docs = spark.range(6400).selectExpr("id AS doc_id", "concat('w', id % 7, ' v') AS text")
    quality.train(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS quality"))
    assert sorted(c for _, _, c, _ in seen[0]) == [0] * 3000 + [1] * 3000


def test_quality_is_a_sparse_dot_product():
    h = quality.Hasher(1 << 10)
    w = np.random.default_rng(0).standard_normal(1 << 10).astype(np.float32)
    m = quality.QualityModel(w, 0.25)
    at, n = h.slots("a b a b C!! 12")
    dense = np.bincount(at, minlength=1 << 10) / n
    assert m.score(h, "a b a b C!! 12") == pytest.approx(1 / (1 + np.exp(-(0.25 + dense @ w))), rel=1e-5)


SMALL = lm.Shape(tokens=100, hidden=6)
PATH = tokenizer_path()


def _random(shape=SMALL, seed=1):
    rng = np.random.default_rng(seed)
    net = lm.Network(shape, rng.permutation(shape.tokens))
    net.flat[:] = rng.standard_normal(len(net.flat)).astype(np.float32) * 0.4
    return net


def _plain(net, t, c):
    """log P of one token by its definition, in Python's floats."""
    k, pad = net.shape.fan, net.shape.hidden
    h = [np.tanh(sum(float(net.embed[c[p]][x]) * float(net.place[p][x]) for p in range(4)) + float(net.bias[x]))
         for x in range(pad)]
    at = int(net.leaf[t])
    path = [(0, at // k ** 2), (at // k ** 2, at // k % k), (at // k, at % k)]
    out = 0.0
    for (w, b), (node, branch) in zip(net.levels, path):
        x = [sum(h[i] * float(w[node][i][j]) for i in range(pad)) + float(b[node][j]) for j in range(k)]
        out += x[branch] - np.log(sum(np.exp(x)))
    return out


def test_lm_equals_its_definition_and_adds_up_to_one():
    net = _random()
    rng = np.random.default_rng(3)
    t, c = rng.integers(0, 100, 300), rng.integers(0, 101, (300, 4))
    assert net.log_prob(t, c, most=64) == pytest.approx([_plain(net, a, b) for a, b in zip(t, c)], abs=1e-4)
    every, ctx = np.arange(100), np.repeat(c[:1], 100, axis=0)
    assert np.exp(net.log_prob(every, ctx)).sum() < 1.0  # leaves that no token has
    whole = lm.Shape(tokens=125, hidden=6)
    net = _random(whole)
    assert np.exp(net.log_prob(np.arange(125), np.repeat(c[:1], 125, axis=0))).sum() == pytest.approx(1.0, abs=1e-4)


def test_lm_begins_at_the_frequencies():
    counts = np.random.default_rng(0).integers(0, 50, 100)
    net = lm.Network(SMALL).begin_at(counts)
    got = net.log_prob(np.arange(100), np.full((100, 4), 100))
    assert np.exp(got) == pytest.approx((counts + 1) / (counts + 1).sum(), rel=1e-3)


def test_lm_gradient():
    """The first Adagrad step moves every parameter against the sign of its
    slope, measured by differences."""
    net = _random()
    t, c = np.array([7, 7, 31]), np.array([[1, 2, 3, 100], [2, 2, 5, 9], [100, 100, 4, 1]])
    slope = np.zeros(len(net.flat))
    for i in np.unique(np.random.default_rng(2).integers(0, len(net.flat), 400)):
        one = net.flat[i]
        lp = []
        for e in (1e-2, -1e-2):
            net.flat[i] = one + e
            lp.append(net.log_prob(t, c).sum())
        net.flat[i] = one
        slope[i] = (lp[0] - lp[1]) / 2e-2
    before, flat = net.log_prob(t, c).sum(), net.flat.copy()
    net.train(t, c, lm.Network(SMALL, net.leaf, np.zeros_like(net.flat)), 1e-3, 8)
    moved = np.flatnonzero(np.abs(slope) > 0.02)
    assert len(moved) > 20 and (np.sign(net.flat - flat)[moved] == np.sign(slope)[moved]).all()
    assert net.log_prob(t, c).sum() > before


def test_lm_windows():
    t, c = lm.windows([np.array([5, 6, 7]), np.array([], dtype=int), np.array([8])], 9)
    assert t.tolist() == [5, 6, 7, 8]
    assert c.tolist() == [[9, 9, 6, 7], [9, 5, 7, 9], [5, 6, 9, 9], [9, 9, 9, 9]]


def test_lm_sequence_is_its_windows():
    """A sequence gives the log-probabilities and the training of its windows
    one by one; each embedding is read once for them."""
    class Counted(np.ndarray):
        rows = 0

        def take(self, ids, axis=None):
            Counted.rows += len(ids)
            return np.asarray(self).take(ids, axis=axis)
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 100, n) for n in (1, 0, 2, 7, 3000, 60)]
    flat, at = lm.joined(texts, 100)
    assert flat[at].tolist() == np.concatenate(texts).tolist()
    net = _random()
    want = net.log_prob(*lm.windows(texts, 100))
    net.embed = net.embed.view(Counted)
    assert net.log_prob_at(flat, at) == pytest.approx(want, abs=1e-5)
    assert Counted.rows <= len(flat)
    assert net.log_prob_at(flat, at, most=50) == pytest.approx(want, abs=1e-5)
    ways = []
    for sequence in (True, False):
        net, seen = _random(), lm.Network(SMALL)
        seen.flat[:] = 0
        if sequence:
            net.train_at(flat, at, seen, 0.1, 4096)
        else:
            net.train(*lm.windows(texts, 100), seen, 0.1, 4096)
        ways.append(net)
    assert ways[0].flat == pytest.approx(ways[1].flat, abs=2e-3)


def test_lm_encoder_is_shared_by_a_worker():
    one = packing.encoder(PATH, 500_000)
    assert one is packing.encoder(PATH, 500_000)
    met = [x.tolist() for x in one.encode(["zzqqx vvkk", "the cat"])]
    assert met == [x.tolist() for x in one.encode(["zzqqx vvkk", "the cat"])]
    assert "zzqqx" in one.known


def test_lm_tokens_and_counts_cover_all(docs, doc_rows):
    from collections import Counter

    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(PATH)
    want = {d: lib.encode(t or "", add_special_tokens=False).ids for d, t in doc_rows}
    rows, ids, n = lm.tokenized(docs, PATH, keep=["doc_id"])
    got = {r.doc_id: np.frombuffer(r[ids], "<u2").tolist() for r in rows.collect()}
    assert got == want
    counts = lm.token_counts(rows, ids, lm.vocabulary_size(PATH))
    assert {i: x for i, x in enumerate(counts.tolist()) if x} == dict(Counter(i for x in want.values() for i in x))


def test_lm_prefers_text_in_order(spark, docs):
    some = docs.where("lang = 'en'")
    net = lm.train(some, PATH, buffer=4096, step=256, per_trainer=60_000)  # several trainers
    text = some.select("text").orderBy("doc_id").limit(60)
    rng = np.random.default_rng(0)
    pairs = []
    for i, r in enumerate(text.collect()):
        w = r.text.split()
        if len(w) >= 20:
            pairs.append((i, " ".join(w), " ".join(rng.permutation(w))))
    df = spark.createDataFrame([(i, a) for i, a, _ in pairs] + [(i + 1000, b) for i, _, b in pairs],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in lm.score(df, net, PATH).collect()}
    assert np.mean([got[i].mean_log_prob > got[i + 1000].mean_log_prob for i, _, _ in pairs]) > 0.6
    assert np.mean([got[i].mean_log_prob for i, _, _ in pairs]) > 1.0 - np.log(lm.vocabulary_size(PATH))
    for r in got.values():
        assert r.log_prob == pytest.approx(r.mean_log_prob * r.n_tokens, rel=1e-9)


def test_lm_odd(odd, empty):
    net = lm.train(odd, PATH)
    out = lm.score(odd.withColumn("n_tokens", F.lit("x")).withColumn("log_prob", F.lit("x")), net, PATH)
    assert {"n_tokens", "_n_tokens", "log_prob", "_log_prob", "mean_log_prob"} <= set(out.columns)
    got = out.collect()
    assert len(got) == odd.count()
    for r in got:
        if r.text is None or not r.text.strip():
            assert (r._n_tokens, r._log_prob, r.mean_log_prob) == (0, 0.0, None)
        else:
            assert r._n_tokens > 0 and r._log_prob < 0
    two = [r._log_prob for r in got if r.doc_id == 2]
    assert len(two) == 2 and two[0] == pytest.approx(two[1], rel=1e-6)
    nothing = lm.train(empty, PATH)
    assert lm.score(empty, nothing, PATH).collect() == []
    assert lm.score_corpus(empty, PATH).collect() == []
