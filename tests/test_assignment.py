import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sightline.operators import assignment, boxes
from sightline.session import materialize

BOXES = "camera_id string, frame_no long, det_seq long, x1 double, y1 double, x2 double, y2 double"
NAN, INF = float("nan"), float("inf")


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    return w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), unique=True, max_size=40), st.randoms())
def test_best_first_is_sequential(edges, rnd):
    rnd.shuffle(edges)
    a, b = (np.array([e[i] for e in edges], dtype=int) for i in (0, 1))
    used_a, used_b, want = set(), set(), []
    for x, y in edges:
        want.append(x not in used_a and y not in used_b)
        if want[-1]:
            used_a.add(x)
            used_b.add(y)
    assert assignment.best_first(a, b, np.arange(len(edges))).tolist() == want


@pytest.mark.parametrize("local", [4096, 10])
def test_greedy_matching(spark, local):
    """The same on few and on many pairs a group; a group of a third of all rows."""
    rnd = random.Random(5)
    rows = [(g, a, b, rnd.randrange(8) / 8.0, f"x{a}{b}") for g in range(6) for a in range(12) for b in range(8)
            if rnd.random() < (0.9 if g == 0 else 0.1)]
    rows += [(None, 1, 1, 0.5, "n"), (1, None, 1, 0.5, "n"), (1, 50, 51, None, "n")]
    df = spark.createDataFrame(rows, "g long, a long, b long, w double, extra string")
    got = assignment.greedy_matching(df, ["g"], ["a"], ["b"], [("w", False)], local=local)
    want, used = [], set()
    for r in sorted((r for r in rows if None not in r[:4]), key=lambda r: (-r[3], r[1], r[2])):
        if (r[0], "a", r[1]) not in used and (r[0], "b", r[2]) not in used:
            used |= {(r[0], "a", r[1]), (r[0], "b", r[2])}
            want.append(r)
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert assignment.greedy_matching(df.limit(0), ["g"], ["a"], ["b"], [("w", False)]).count() == 0


def test_second_choice_counts(spark):
    """Two predictions prefer one truth; the other truth is free for the loser."""
    df = spark.createDataFrame([(1, 1, 1, 0.9), (1, 1, 2, 0.8), (1, 2, 2, 0.5)], "f long, t long, p long, iou double")
    got = assignment.greedy_matching(df, ["f"], ["t"], ["p"], [("iou", False)])
    assert sorted((r.t, r.p) for r in got.collect()) == [(1, 1), (2, 2)]
    assert boxes.mutual_best(df, ["t"], ["p"], "iou").count() == 1


def test_curve_and_average_precision(spark):
    preds = spark.createDataFrame([("c", 0.9), ("c", 0.8), ("c", 0.7), ("c", 0.7), ("d", 0.5), ("c", NAN), ("c", None)],
                                  "cam string, s double")
    hits = spark.createDataFrame([("c", 0.9), ("c", 0.7)], "cam string, s double")
    truths = spark.createDataFrame([("c",), ("c",), ("c",), ("e",)], "cam string")
    curve = assignment.precision_recall_curve(preds, truths, hits, "cam", "s")
    got = sorted((r.cam, r.threshold, r.n_pred, r.tp, r.n_truth, round(r.precision, 6), r.recall and round(r.recall, 6))
                 for r in curve.collect())
    assert got == [("c", 0.7, 4, 2, 3, 0.5, 0.666667), ("c", 0.8, 2, 1, 3, 0.5, 0.333333), ("c", 0.9, 1, 1, 3, 1.0, 0.333333),
                   ("d", 0.5, 1, 0, 0, 0.0, None)]
    ap = {r.cam: r.ap for r in assignment.average_precision(curve, "cam").collect()}
    assert abs(ap["c"] - (1 / 3 * 1.0 + 1 / 3 * 0.5)) < 1e-9 and ap["d"] is None


# boxes that are none, and very large ones ---------------------------------

ODD = [(0.0, 0.0, NAN, 10.0), (NAN, NAN, NAN, NAN), (0.0, 0.0, INF, 10.0), (-INF, 0.0, 10.0, 10.0), (None, 0.0, 10.0, 10.0),
       (10.0, 10.0, 0.0, 0.0), (5.0, 5.0, 5.0, 9.0)]


def test_boxes_that_are_none_neither_suppress_nor_match(spark):
    good = [(0.0, 0.0, 10.0, 10.0), (0.0, 0.0, 10.0, 9.0), (200.0, 0.0, 210.0, 10.0)]
    rows = [(1, i, 0.4 - i / 100, *b) for i, b in enumerate(good)] + [(1, 10 + i, 0.9, *b) for i, b in enumerate(ODD)]
    df = spark.createDataFrame(rows, "frame_id long, det_seq long, confidence double, x1 double, y1 double, x2 double, y2 double")
    assert [(r.a_det_seq, r.b_det_seq, r.iou) for r in boxes.iou_pairs(df).collect()] == [(0, 1, 0.9)]
    kept = sorted(r.det_seq for r in boxes.nms(df).collect())
    assert kept == [0, 2] + [10 + i for i in range(len(ODD))]


def test_huge_boxes_cost_a_row(spark):
    """A box over millions of cells meets its frame by the frame's key."""
    rows = [(1, 0, 0.0, 0.0, 1e9, 10.0), (1, 1, 50.0, 0.0, 70.0, 10.0), (1, 2, 9e8, 0.0, 1e9, 1e9), (2, 0, 0.0, 0.0, 5.0, 5.0),
            (1, 3, 60.0, 5.0, 80.0, 15.0)]
    df = spark.createDataFrame(rows, "frame_id long, det_seq long, x1 double, y1 double, x2 double, y2 double")
    got = sorted((r.a_det_seq, r.b_det_seq) for r in boxes.iou_pairs(df).collect())
    assert got == [(0, 1), (0, 2), (0, 3), (1, 3)]
    some = boxes.overlap_pairs(df, df, ["frame_id"], ["frame_id"], ["det_seq"], ["det_seq"], most_cells=1)
    same = boxes.overlap_pairs(df, df, ["frame_id"], ["frame_id"], ["det_seq"], ["det_seq"])
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, same.collect()))


# lost tracks ----------------------------------------------------------------

def moving_boxes(seed=4, frames=25):
    rnd, rows = random.Random(seed), []
    for cam in ("c1", "c2"):
        objects = [(rnd.uniform(0, 200), rnd.uniform(0, 200)) for _ in range(6)]
        for f in range(frames):
            objects = [(x + rnd.uniform(-4, 4), y + rnd.uniform(-4, 4)) for x, y in objects]
            seq = 0
            for x, y in objects:
                if rnd.random() < 0.7:                           # often lost
                    rows.append((cam, f, seq, x, y, x + 20, y + 20))
                    seq += 1
    return rows


def frame_by_frame(rows, grace, threshold=0.3):
    """A plain tracker: each frame asks the frames before it, nearest first;
    best partners of each other are linked."""
    links, has_next, has_before = [], set(), set()
    at = {}
    for r in rows:
        at.setdefault((r[0], r[1]), []).append(r)
    for cam, f in sorted(at):
        for gap in range(1, grace + 1):
            old = [r for r in at.get((cam, f - gap), []) if r[:3] not in has_next]
            new = [r for r in at[cam, f] if r[:3] not in has_before]
            score = {(a[2], b[2]): round(iou(a[3:], b[3:]), 9) for a in old for b in new if iou(a[3:], b[3:]) >= threshold}
            best_a = {a[2]: min(((-s, j) for (i, j), s in score.items() if i == a[2]), default=None) for a in old}
            best_b = {b[2]: min(((-s, i) for (i, j), s in score.items() if j == b[2]), default=None) for b in new}
            for (i, j), s in score.items():
                if best_a[i] == (-s, j) and best_b[j] == (-s, i):
                    links.append((cam, f - gap, i, f, j, gap))
                    has_next.add((cam, f - gap, i))
                    has_before.add((cam, f, j))
    return sorted(links)


@pytest.mark.parametrize("grace", [1, 3])
def test_gap_links_equal_a_plain_tracker(spark, grace):
    rows = moving_boxes()
    df = spark.createDataFrame(rows + [("c1", 3, 90, NAN, 0.0, 5.0, 5.0)], BOXES)
    got = boxes.gap_links(df, grace=grace).collect()
    assert sorted((r.camera_id, r.frame_no, r.det_seq, r.next_frame_no, r.next_det_seq, r.gap) for r in got) == \
        frame_by_frame(rows, grace)
    assert any(r.gap == 3 for r in got) == (grace == 3)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_boxes_of_small_frames_are_not_copied(spark):
    """One copy of a box moves; only crowded frames go through the grid, with
    the same pairs."""
    df = materialize(spark.createDataFrame(
        [(f, s, float(20 * s), 0.0, 20.0 * s + 150, 150.0) for f in range(3) for s in range(4 + 8 * f)] + [(None, 0, 0.0, 0.0, 9.0, 9.0)],
        "frame_id long, det_seq long, x1 double, y1 double, x2 double, y2 double"))
    way = (df, df, ["frame_id"], ["frame_id"], ["det_seq"], ["det_seq"])
    whole, some, grid = (boxes.overlap_pairs(*way, most_boxes=n) for n in (256, 10, 0))
    assert "Generate" not in plan(whole) and "Generate" in plan(some)
    rows = [sorted(tuple(r) for r in x.collect()) for x in (whole, some, grid)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) > 300


def test_gap_links_of_crowded_frames_and_over_block_ends(spark):
    """Tracks over every frame border, with and without the grid."""
    rows = [("cam1", n, s, 50.0 * s, 0.0, 50.0 * s + 40, 40.0) for n in range(1, 60) for s in range(30) if (n + s) % 5]
    rows += [(None, 3, 0, 0.0, 0.0, 9.0, 9.0), ("cam1", None, 0, 0.0, 0.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "camera_id string, frame_no long, det_seq long, x1 double, y1 double, x2 double, y2 double")
    got = sorted((r.frame_no, r.det_seq, r.next_frame_no, r.next_det_seq, r.gap) for r in boxes.gap_links(df, grace=2).collect())
    seen = {(n, s) for c, n, s, *_ in rows if c and n}
    want = [(n, s, n + (1 if (n + 1, s) in seen else 2), s, 1 if (n + 1, s) in seen else 2)
            for n, s in seen if (n + 1, s) in seen or (n + 2, s) in seen]
    assert got == sorted(want)
