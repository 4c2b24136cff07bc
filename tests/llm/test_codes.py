import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.llm import codes
from tests.conftest import SF_ORACLE
from tests.llm.conftest import rows_of

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """[(id, code, error, label)] and books by length, by full search in Python's integers."""
    out, books = [], {}
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            most = math.floor(math.sqrt(2.0 ** 61 / max(1, len(v)))) - 1
            most = min(most, 2 ** 31 - 1)
            kept.append((i, [math.floor(max(-most, min(most, x * scale))) for x in v], label))
    for n in sorted({len(v) for _, v, _ in kept}):
        mine = [(i, v, la) for i, v, la in kept if len(v) == n]
        least = {}
        for i, v, _ in mine:
            least[i] = min(v, least.get(i, v))
        ids = sorted(least, key=lambda i: (i is None, i or 0))[:entries]
        code, error = [[] for _ in mine], [0] * len(mine)
        books[n] = []
        for p in range(parts):
            a, b = p * n // parts, (p + 1) * n // parts
            book = [least[i][a:b] for i in ids]

            def nearest(v):
                d = [sum((x - y) ** 2 for x, y in zip(v, e)) for e in book]
                return d.index(min(d)), min(d)
            for _ in range(rounds):
                held = {}
                for _i, v, _la in mine:
                    held.setdefault(nearest(v[a:b])[0], []).append(v[a:b])
                for k, vs in held.items():
                    book[k] = [sum(c) // len(vs) for c in zip(*vs)]
            for j, (_, v, _) in enumerate(mine):
                k, d = nearest(v[a:b])
                code[j].append(k)
                error[j] += d
            books[n].append(book)
        out += [(i, bytes(c).hex(), e, la) for (i, _, la), c, e in zip(mine, code, error)]
    return out, books


def check(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    found, books = codes.vector_codes(df, keep=["vec_id", "label"], **how)
    want, want_books = brute(rows, **{k: v for k, v in how.items() if k not in ("b", "share")})
    assert rows_of(found.select("vec_id", "code", "error", "label")) == sorted(want, key=repr)
    for n, bs in want_books.items():
        flat = ",".join(str(x) for book in bs for e in book for x in e)
        assert books.digest(n) == hashlib.sha256(flat.encode()).hexdigest()
    return found, books


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, -0.2, 0.3, 0.4], 0), (1, [0.1, -0.3, 0.3, 0.4], None), (1, [0.1, -0.2, 0.3, 0.4], 0),
            (None, [0.5, 0.5, 0.5, 0.5], None), (2, None, 1), (3, [0.1, None, 0.2, 0.3], 1), (4, [nan, 0.0, 0.0, 0.0], 1),
            (5, [inf, 0.0, 0.0, 0.0], 1), (6, [1e30, -1e300, 7.0, -0.0], 1), (7, [0.0, 0.0, 0.0, 0.0], 2),
            (8, [1e-9, -1e-9, 0.0, 0.0], 2), (9, [], 2), (10, [], None), (11, [1.0, 2.0], 3), (12, [1.0, 2.5, 3.0, 4.0, 5.0, 6.5], 3),
            (13, [1.5, 2.5, 3.0, 4.0, 5.0, 6.5], 3)]
    found, books = check(spark, rows, entries=3)
    check(spark, rows, entries=256, b=2)
    joined = codes.with_group_error(found, books, "label")
    of = {}
    for r in found.collect():
        of[r.label] = of.get(r.label, 0) + r.error
    fits = {k: v if v < 2 ** 63 else None for k, v in of.items()}
    assert all(r.group_error == fits[r.label] for r in joined.collect())
    assert joined.count() == found.count()


@pytest.mark.parametrize("b,share", [(2, 0.5), (4, 0.99), (40, 0.9)])
def test_bounds_give_what_full_search_gives(spark, b, share):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(25, 8))
    rows = [(i, (centres[i % 25] + rng.normal(scale=0.2 if i % 7 else 0.0, size=8)).tolist(), i % 3) for i in range(600)]
    check(spark, rows, entries=40, rounds=5, b=b, share=share)


def test_coarse_ties(spark):
    """Few distinct values: most distances tie."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-1, 2, 8) / 512).tolist(), None) for i in range(300)]
    check(spark, rows, entries=64, b=3)


def test_given_table(spark):
    df = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").where("vec_id < 120")
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in df.collect()]
    check(spark, rows, entries=16)


def test_empty_and_names(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert codes.vector_codes(none)[0].count() == 0
    found, books = codes.vector_codes(none, keep=["vec_id", "label"])
    assert codes.with_group_error(found, books).count() == 0
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], 1)], SCHEMA).withColumn("code", F.lit("x")).withColumn("v", F.lit(1))
    assert codes.vector_codes(df)[0].count() == 1
    with pytest.raises(ValueError):
        codes.vector_codes(df, keep=["code"])


def test_bounds_round_down():
    x = np.array([[0.0, 1e-30, 1 / 3, 1.0, 12345.678, 1e9, np.inf]])
    back = codes.unpack_bounds(codes.pack_bounds(x))
    assert (back <= x).all() and np.isinf(back[0, -1]) and (back[0, 2:-1] > 0.99 * x[0, 2:-1]).all()
