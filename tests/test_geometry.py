"""Geometry fixtures and properties."""

import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sightline.functions import geometry as G
from sightline.operators import boxes


def test_fit_inside_cases(spark):
    df = spark.createDataFrame([(1920, 1080), (640, 480), (100, 2000)], "w int, h int")
    nw, nh = G.fit_inside(F.col("w"), F.col("h"))
    assert [tuple(r) for r in df.select(nw, nh).collect()] == [(640, 360), (640, 480), (24, 480)]


def test_truncation_toward_zero(spark):
    df = spark.createDataFrame([(-1.7,), (2.9,)], "v double")
    assert [r[0] for r in df.select(G.truncate_int(F.col("v"))).collect()] == [-1, 2]


def test_ground_positions(spark):
    df = spark.createDataFrame([(0,), (479,), (480,), (691199,)], "p int")
    got = [(round(r[0], 6), round(r[1], 6)) for r in
           df.select(G.ground_x(F.col("p")), G.ground_y(F.col("p"))).collect()]
    assert got == [(-3.0, -9.0), (8.975, -9.0), (-3.0, -8.975), (8.975, 26.975)]


def _py_iou(a, b):
    iw = max(0.0, min(a[2], b[2]) - max(a[0], b[0]))
    ih = max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    inter = iw * ih
    area = lambda r: max(0.0, r[2] - r[0]) * max(0.0, r[3] - r[1])
    u = area(a) + area(b) - inter
    return inter / u if u > 0 else 0.0


coord = st.integers(min_value=0, max_value=200).map(float)
box = st.tuples(coord, coord, coord, coord).map(lambda t: (min(t[0], t[2]), min(t[1], t[3]),
                                                           max(t[0], t[2]), max(t[1], t[3])))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(box, box), min_size=1, max_size=20))
def test_iou_symmetric_bounded(spark, pairs):
    rows = [(*a, *b) for a, b in pairs]
    df = spark.createDataFrame(rows, "ax1 double, ay1 double, ax2 double, ay2 double, "
                                     "bx1 double, by1 double, bx2 double, by2 double")
    a, b = G.box("a"), G.box("b")
    out = df.select(G.iou(a, b).alias("ab"), G.iou(b, a).alias("ba")).collect()
    for (pa, pb), r in zip(pairs, out):
        assert r.ab == r.ba and 0.0 <= r.ab <= 1.0
        assert abs(r.ab - _py_iou(pa, pb)) < 1e-12


def test_zero_area_and_disjoint(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 1.0, 1.0, 5.0, 5.0, 6.0, 6.0)],
                               "ax1 double, ay1 double, ax2 double, ay2 double, "
                               "bx1 double, by1 double, bx2 double, by2 double")
    assert [r[0] for r in df.select(G.iou(G.box("a"), G.box("b"))).collect()] == [0.0, 0.0]


DET = "frame_id long, det_seq long, x1 double, y1 double, x2 double, y2 double, confidence double"


def _greedy(rows, t):
    kept = {}
    for r in sorted(rows, key=lambda r: (-r[6], r[1])):
        fk = kept.setdefault(r[0], [])
        if all(_py_iou(r[2:6], k[2:6]) <= t for k in fk):
            fk.append(r)
    return {(r[0], r[1]) for fk in kept.values() for r in fk}


def test_nms_tie_keeps_lower_seq(spark):
    df = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0, 0.8), (1, 1, 0.0, 0.0, 10.0, 10.0, 0.8)], DET)
    assert [r.det_seq for r in boxes.nms(df).collect()] == [0]


def test_nms_equals_sequential_greedy_and_is_idempotent(spark):
    rnd = random.Random(7)
    rows = []
    for f in range(30):
        for s in range(rnd.randint(1, 12)):
            x, y = rnd.randint(0, 150), rnd.randint(0, 150)
            w, h = rnd.randint(5, 90), rnd.randint(5, 90)
            rows.append((f, s, float(x), float(y), float(x + w), float(y + h), rnd.choice([0.3, 0.5, 0.7, 0.9])))
    df = spark.createDataFrame(rows, DET)
    kept = boxes.nms(df, cell=32.0)
    got = {(r.frame_id, r.det_seq) for r in kept.collect()}
    assert got == _greedy(rows, 0.5)
    again = {(r.frame_id, r.det_seq) for r in boxes.nms(kept, cell=32.0).collect()}
    assert again == got
    by_frame = {}
    for r in rows:
        if (r[0], r[1]) in got:
            by_frame.setdefault(r[0], []).append(r)
    for fr in by_frame.values():
        for a, b in itertools.combinations(fr, 2):
            assert _py_iou(a[2:6], b[2:6]) <= 0.5


def test_grid_pairs_equal_all_pairs(spark):
    rnd = random.Random(3)
    rows = [(f, s, float(x), float(y), float(x + rnd.randint(0, 80)), float(y + rnd.randint(0, 80)), 0.5)
            for f in range(10) for s in range(10)
            for x, y in [(rnd.randint(0, 200), rnd.randint(0, 200))]]
    df = spark.createDataFrame(rows, DET)
    got = {(r.a_frame_id, r.a_det_seq, r.b_det_seq): r.iou for r in boxes.iou_pairs(df, cell=16.0).collect()}
    want = {}
    for a, b in itertools.combinations(rows, 2):
        if a[0] == b[0]:
            lo, hi = (a, b) if a[1] < b[1] else (b, a)
            v = _py_iou(lo[2:6], hi[2:6])
            if v > 0:
                want[(a[0], lo[1], hi[1])] = v
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
