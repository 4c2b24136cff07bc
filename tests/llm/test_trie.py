import hashlib
import zlib

import numpy as np
import pytest

from sightline.llm import trie
from sightline.session import materialize
from tests.conftest import SF_ORACLE
from tests.llm.conftest import rows_of


def brute_trie(convs):
    """Rows of the trie of {conv: [(role, text), ...]}."""
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids, saved, leaves = {}, {}, {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        saved[p] = own + sum(saved[k] for k in kids.get(p, []))
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
                   for p, m in members.items()), key=repr)


def rebuilt(rows, every=100, heads=6):
    """Conversations of (conv, turn, role, text) rows after ``shared_openings``."""
    of = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            of.setdefault(c, []).append((turn is not None, turn or 0, tie, (role, text)))
    of = {c: [t[-1] for t in sorted(ts)] for c, ts in of.items()}
    out = {}
    for c, own in of.items():
        h = zlib.crc32(str(c).encode()) % heads
        out[c] = of.get(c - int(np.fmod(c, every)), [])[:h] + own[h:]
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def test_odd_rows(spark):
    rows = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", None), (0, None, None, "first"),
            (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (2, 5, None, None), (None, 0, "user", "lost"),
            (-5, 0, "user", "a"), (-5, 1, "user", "\U0001f600é"), (3, 0, "", ""), (104, 0, "user", "no base"),
            (9, 0, "user", "long " * 50_000)]
    rows += [(c, t, "user", f"turn {t}") for c in (200, 201, 202, 203, 207) for t in range(8)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS owner", "'x' AS depth", "2 AS conv", "3 AS pos", "4 AS x")
    got = trie.conversation_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert rows_of(got) == brute_trie(rebuilt(rows))
    assert rows_of(trie.conversation_trie(df, bound=4)) == rows_of(got)


def test_empty(spark):
    assert rows_of(trie.conversation_trie(spark.createDataFrame([], SCHEMA))) == []
    assert rows_of(trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))) == []


def test_rounds_over_large_components(spark):
    df = spark.read.parquet(f"{SF_ORACLE}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(trie.conversation_trie(df, bound=8)) == brute_trie(rebuilt(rows))


def test_one_conversation_and_many_copies(spark, monkeypatch):
    """A chain far above the bound, over several runs and parts, and a
    conversation that most others copy."""
    monkeypatch.setattr(trie, "_RUN", 16)
    rows = [(7, t, "user", f"t{t % 11}") for t in range(300)]
    rows += [(c, t, "user", f"t{t}") for c in range(1000, 1400, 2) for t in range(3)]
    df = materialize(spark.createDataFrame(rows, SCHEMA))
    n = trie.numbered_turns(df)
    convs = materialize(trie.conversations(n), "convs")
    got = rows_of(trie.prefix_trie(materialize(n, "numbered"), convs, bound=40))
    of = {}
    for c, t, role, text in rows:
        of.setdefault(c, []).append((role, text))
    assert got == brute_trie(of)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_centroid_sums(shape):
    rng = np.random.default_rng(5)
    n = 400
    if shape == "chain":
        parent = np.arange(n) - 1
    elif shape == "star":
        parent = np.where(np.arange(n) == 0, -1, 0)
    else:
        parent = np.array([-1] + [int(rng.integers(0, i)) for i in range(1, n)])
        if shape == "forest":
            parent[rng.integers(0, n, 20)] = -1
    layer = np.zeros(n, dtype=int)
    for i in range(n):
        layer[i] = 0 if parent[i] < 0 else layer[parent[i]] + 1
    mix = rng.permutation(n)
    back = np.argsort(mix)
    parent, layer = np.where(parent[mix] < 0, -1, back[parent[mix]]), layer[mix]
    values = rng.integers(-50, 50, (n, 2))
    want = values.copy()
    for i in np.argsort(-layer, kind="stable"):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
    assert (trie.centroid_sums(parent, layer, values) == want).all()


def test_ends_over_several_strings(spark):
    ends = [(1, 0, c) for c in range(-30, 1000)] + [(2, 3, 5)]
    got = rows_of(trie.ends_digests(spark.createDataFrame(ends, "owner long, depth long, conv long"), together=7))
    want = [(1, 0, hashlib.sha256(",".join(map(str, range(-30, 1000))).encode()).hexdigest()),
            (2, 3, hashlib.sha256(b"5").hexdigest())]
    assert got == sorted(want, key=repr)
