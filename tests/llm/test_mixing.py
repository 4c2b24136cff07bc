"""Mixing: targets against repeated sharing, words against targets."""

import numpy as np
import pytest

from sightline.llm import mixing
from tests.llm import brute
from tests.llm.conftest import ODD, rows_of


def n_words(t):
    return len(brute.WORD.findall(t or ""))


def sizes_of(rows):
    out = {}
    for _, t, s in rows:
        out[s] = out.get(s, 0) + n_words(t)
    return out


@pytest.mark.parametrize("options", [{}, {"block": 7, "fan_in": 2}])
def test_words_meet_targets(docs, options):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    sizes, source = sizes_of(rows), {i: s for i, _, s in rows}
    want = brute.targets(sizes)
    got = mixing.mix_to_targets(docs, **options).collect()
    assert sorted((r.doc_id, r["size"]) for r in got) == sorted((i, n_words(t)) for i, t, _ in rows)
    taken, longest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) <= 1e-9 * want[s]
        assert 0 <= r.copies <= 3
        taken[s] += r.copies * r["size"]
        longest[s] = max(longest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s], s


def test_reruns_agree(docs):
    a = rows_of(mixing.mix_to_targets(docs, block=16))
    assert a == rows_of(mixing.mix_to_targets(docs.repartition(5), block=16))


def test_pivot_keeps_expectation_and_mass():
    rng = np.random.default_rng(0)
    w = np.array([5.0, 1.0, 9.0, 4.0, 2.0, 7.0])
    p0 = np.array([0.2, 0.5, 0.9, 0.3, 0.6, 0.5])
    total = np.zeros(6)
    for _ in range(4000):
        p = p0.copy()
        open_at = mixing._pivot(p, w, rng)
        assert ((p > 0) & (p < 1)).sum() == (open_at >= 0)
        assert abs((p * w).sum() - (p0 * w).sum()) < 1e-9
        total += p
    assert np.abs(total / 4000 - p0).max() < 0.03


def test_odd(odd, empty):
    rows = [(r[0], r[1], r[3]) for r in ODD]
    sizes = sizes_of(rows)
    want = brute.targets(sizes)
    got = mixing.mix_to_targets(odd).collect()
    assert sorted(((r.doc_id, r["size"]) for r in got), key=repr) == sorted(
        ((i, n_words(t)) for i, t, _ in rows), key=repr)
    assert {round(r.target, 6) for r in got} == {round(x, 6) for x in want.values()}
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    copies = {(r.doc_id, r["size"]): r.copies for r in mixing.mix_to_targets(odd).collect()}
    assert sum(1 for r in out.collect() if r.doc_id == 2) == 2 * copies[2, 5]
    assert mixing.mix_to_targets(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []
    blank = odd.where("doc_id in (3, 4, 5)")
    assert all(r.copies == 0 for r in mixing.mix_to_targets(blank).collect())


def test_targets_stop_at_three_times(spark):
    sizes = [("a", 4, 10), ("b", 2, 1000), ("c", 2, 1), (None, 1, 500), ("", 1, 0)]
    df = spark.createDataFrame(sizes, "source string, docs long, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = brute.targets({s: n for s, _, n in sizes})
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-9 * max(1, want[s]) for s in want)
    assert got["c"] == 3.0 and got[""] == 0.0
