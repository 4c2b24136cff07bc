"""Box-pair operators: overlaps, IoU pairs, NMS, linking, evaluation.

Boxes of a frame meet by its key, one copy of each, as long as a frame
holds few. Pairs of a crowded frame are never formed as all its pairs:
its boxes are placed on a grid of ``cell`` pixels; each box is copied to
the cells it covers and boxes meet only when they share a cell (an
equi-join on frame key + cell). A pair is reported once, in the cell
holding the top-left corner of the pair's intersection, so the result is
exact and free of duplicates. A frame with very many boxes is thereby
split into its occupied cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions.geometry import iou, is_box
from sightline.session import checkpoint_dir, materialize

BOX = ("x1", "y1", "x2", "y2")


def overlap_pairs(a: DataFrame, b: DataFrame, a_keys: Sequence[str], b_keys: Sequence[str],
                  a_cols: Sequence[str], b_cols: Sequence[str], cell: float = 64.0,
                  a_prefix: str = "a_", b_prefix: str = "b_",
                  extra: Column | None = None, most_cells: int = 256, most_boxes: int = 256) -> DataFrame:
    """Pairs (a, b) whose boxes overlap with positive area. Boxes with null,
    NaN or infinite corners, or no area, overlap nothing; a box of more than
    ``most_cells`` cells is not copied to them, however large it is.

    ``a`` rows match ``b`` rows where ``a_keys`` equal ``b_keys`` (same
    frame, or a frame and its successor). ``extra`` is an additional
    predicate on the prefixed columns (e.g. ``a_det_seq < b_det_seq``).
    Output columns: prefixed keys, cols and boxes, plus ``iou``.

    Keys of at most ``most_boxes`` rows of ``b`` are joined as they are: one
    copy of a box moves, and a box of ``a`` is compared with as many. Only
    the other keys go through the grid. ``b`` is counted first, so it should
    be cheap to read.
    """
    def side(df, keys, cols, p):
        sel = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
        sel += [F.col(c).alias(p + c) for c in cols] + [F.col(c).cast("double").alias(p + c) for c in BOX]
        return df.where(is_box(*[F.col(c).cast("double") for c in BOX])).select(*sel)

    on = [f"_k{i}" for i in range(len(a_keys))]
    sa, sb = side(a, a_keys, a_cols, a_prefix), side(b, b_keys, b_cols, b_prefix)
    A = tuple(F.col(a_prefix + c) for c in BOX)
    B = tuple(F.col(b_prefix + c) for c in BOX)
    cond = (F.least(A[2], B[2]) > F.greatest(A[0], B[0])) & (F.least(A[3], B[3]) > F.greatest(A[1], B[1]))
    if extra is not None:
        cond = cond & extra
    if most_boxes <= 0:
        crowded = None
        met = _met_in_cells(sa, sb, on, a_prefix, b_prefix, cond, cell, most_cells)
    else:
        crowded = materialize(sb.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
                              .where(F.col("_n") > most_boxes).select(*on), "crowded")
    if crowded is None:
        pass
    elif crowded.isEmpty():
        met = sa.join(sb, on).where(cond)
    else:
        met = (sa.join(crowded, on, "left_anti").join(sb.join(crowded, on, "left_anti"), on).where(cond)
               .unionByName(_met_in_cells(sa.join(crowded, on, "left_semi"), sb.join(crowded, on, "left_semi"),
                                          on, a_prefix, b_prefix, cond, cell, most_cells)))
    keys_out = [F.col(f"_k{i}").alias(a_prefix + k) for i, k in enumerate(a_keys)]
    return met.withColumn("iou", iou(A, B)).select(
        *keys_out, *[a_prefix + c for c in a_cols], *[b_prefix + c for c in b_cols],
        *[a_prefix + c for c in BOX], *[b_prefix + c for c in BOX], "iou")


def _met_in_cells(sa: DataFrame, sb: DataFrame, on: Sequence[str], a_prefix: str, b_prefix: str, cond: Column,
                  cell: float, most_cells: int) -> DataFrame:
    """The rows of ``sa`` and ``sb`` that are equal in ``on`` and fulfil
    ``cond``, by way of the grid."""
    def measured(df, p):
        across, down = (F.floor(F.col(p + hi) / cell) - F.floor(F.col(p + lo) / cell) + 1
                        for lo, hi in (("x1", "x2"), ("y1", "y2")))
        return df.withColumn("_large", across * down > most_cells)

    def cells(df, p):
        cx = F.sequence(F.floor(F.col(p + "x1") / cell), F.floor(F.col(p + "x2") / cell))
        cy = F.sequence(F.floor(F.col(p + "y1") / cell), F.floor(F.col(p + "y2") / cell))
        return df.withColumn("_cx", F.explode(cx)).withColumn("_cy", F.explode(cy))

    sa, sb = measured(sa, a_prefix), measured(sb, b_prefix)
    small_a, large_a = sa.where("not _large").drop("_large"), sa.where("_large").drop("_large")
    small_b, large_b = sb.where("not _large").drop("_large"), sb.where("_large").drop("_large")
    home = ((F.floor(F.greatest(a_prefix + "x1", b_prefix + "x1") / cell) == F.col("_cx"))
            & (F.floor(F.greatest(a_prefix + "y1", b_prefix + "y1") / cell) == F.col("_cy")))
    met = (cells(small_a, a_prefix).join(cells(small_b, b_prefix), [*on, "_cx", "_cy"])
           .where(cond & home).drop("_cx", "_cy"))
    # boxes of very many cells meet the boxes of their frame by its key
    large = large_a.join(sb.drop("_large"), on).where(cond)
    other = small_a.join(large_b, on).where(cond)
    return met.unionByName(large).unionByName(other)


def iou_pairs(dets: DataFrame, keys: Sequence[str] = ("frame_id",), seq: str = "det_seq",
              cell: float = 64.0) -> DataFrame:
    """Every pair of boxes of one frame with IoU > 0 (a.seq < b.seq)."""
    return overlap_pairs(dets, dets, keys, keys, [seq], [seq], cell,
                         extra=F.col("a_" + seq) < F.col("b_" + seq), most_boxes=0)


def nms(dets: DataFrame, keys: Sequence[str] = ("frame_id",), seq: str = "det_seq",
        score: str = "confidence", iou_threshold: float = 0.5, cell: float = 64.0) -> DataFrame:
    """V2: greedy non-max suppression, distributed.

    Greedy NMS keeps a box iff no *kept* box ranked above it (confidence
    desc, then ``seq`` asc) overlaps it with IoU > t. Only boxes with such
    an overlap ("contested") need work; every other box is kept at once.
    Contested boxes are resolved in rounds: a box with no undecided
    higher-ranked rival is kept, and the boxes it suppresses are dropped.
    This yields exactly the sequential greedy result; the number of
    rounds is the longest chain of rivals, not the frame size. Each round
    reads and writes the edges between undecided boxes only, so the total
    work is bounded by the edges, however long the one longest chain is.
    """
    spark = dets.sparkSession
    checkpoint_dir(spark)
    cols = [seq, score]
    pairs = overlap_pairs(dets, dets, keys, keys, cols, cols, cell,
                          extra=F.col("a_" + seq) != F.col("b_" + seq))
    a_first = ((F.col("a_" + score) > F.col("b_" + score))
               | ((F.col("a_" + score) == F.col("b_" + score)) & (F.col("a_" + seq) < F.col("b_" + seq))))
    kk = ["a_" + k for k in keys]
    # suppression edges hi -> lo (hi ranked above lo)
    edges = (pairs.where((F.col("iou") > iou_threshold) & a_first)
             .select(*[F.col(k).alias(k[2:]) for k in kk],
                     F.col("a_" + seq).alias("hi"), F.col("b_" + seq).alias("lo"))
             .transform(materialize))
    box = [*keys, seq]
    gone: list[DataFrame] = []
    while not edges.isEmpty():
        # kept now: higher-ranked boxes that no undecided box suppresses
        high = edges.select(*keys, F.col("hi").alias(seq)).distinct()
        kept = high.join(edges.select(*keys, F.col("lo").alias(seq)), box, "left_anti").transform(materialize)
        lost = (edges.join(kept.withColumnRenamed(seq, "hi"), [*keys, "hi"], "left_semi")
                .select(*keys, F.col("lo").alias(seq)).distinct().transform(materialize))
        gone.append(lost)
        # only edges between boxes that are still undecided go on; a box whose
        # rivals are all gone has no edge left and stays
        edges = (edges.join(kept.withColumnRenamed(seq, "hi"), [*keys, "hi"], "left_anti")
                 .join(lost.withColumnRenamed(seq, "hi"), [*keys, "hi"], "left_anti")
                 .join(lost.withColumnRenamed(seq, "lo"), [*keys, "lo"], "left_anti")
                 .transform(materialize))
    if not gone:
        return dets
    all_gone = gone[0]
    for g in gone[1:]:
        all_gone = all_gone.unionByName(g)
    return dets.join(all_gone, box, "left_anti")


def gap_links(dets: DataFrame, camera: str = "camera_id", number: str = "frame_no", seq: str = "det_seq",
              grace: int = 1, threshold: float = 0.3, cell: float = 64.0) -> DataFrame:
    """V7 links with a grace for lost tracks: (camera, frame_no, det_seq,
    next_frame_no, next_det_seq, iou, gap).

    Gaps of 1 to ``grace`` frames are taken in turn. In each, boxes that have
    no successor yet meet boxes that have no predecessor yet, as many frames
    later, and those that are each other's best (IoU rounded to 1e-9, then
    the lower ``seq``) are linked. A box's links over smaller gaps are all
    known by then, so this is what a tracker gives that goes frame by frame
    and asks the tracks it saw last first. ``number`` counts a camera's
    frames without holes; frames without boxes count.

    The pairs over all gaps are formed at once, in blocks of consecutive
    frames: a box moves to its own block, as a successor also to the block
    before if its predecessors may lie there. What is decided gap by gap are
    the pairs over the threshold."""
    width = max(16, 4 * grace)
    boxes = dets.select(camera, number, seq, *BOX)
    first = F.floor((F.col(number) - grace) / width)
    a = boxes.withColumn("_block", F.floor(F.col(number) / width))
    b = boxes.withColumn("_block", F.explode(F.sequence(first, F.floor((F.col(number) - 1) / width))))
    ahead = F.col("b_" + number) - F.col("a_" + number)
    pairs = overlap_pairs(a, b, [camera, "_block"], [camera, "_block"], [number, seq], [number, seq], cell,
                          extra=ahead.between(1, grace), most_boxes=1024)
    a_id, b_id = [camera, number, seq], [camera, "next_" + number, "next_" + seq]
    pairs = materialize(pairs.where(F.col("iou") >= threshold).select(
        F.col("a_" + camera).alias(camera), F.col("a_" + number).alias(number), F.col("a_" + seq).alias(seq),
        F.col("b_" + number).alias("next_" + number), F.col("b_" + seq).alias("next_" + seq), "iou",
        ahead.cast("int").alias("gap")), "gap-pairs")
    out: DataFrame | None = None
    for gap in range(1, grace + 1):
        free = pairs.where(F.col("gap") == gap)
        if out is not None:
            # the heads last: their ranks are taken in the same partitions
            free = free.join(out.select(*b_id), b_id, "left_anti").join(out.select(*a_id), a_id, "left_anti")
        found = mutual_best(free.withColumn("_iou9", F.round("iou", 9)), a_id, b_id, "_iou9",
                            tie_a=seq, tie_b="next_" + seq)
        found = materialize(found.drop("_iou9"), "gap-links")
        out = found if out is None else out.unionByName(found)
    return out


def mutual_best(pairs: DataFrame, a_id: Sequence[str], b_id: Sequence[str],
                score: str = "iou", tie_a: str | None = None, tie_b: str | None = None) -> DataFrame:
    """Keep pairs that are each side's best partner (score desc, then the
    partner's id asc). Both ranks are computed over all pairs, one window
    after the other on the same rows, so the pairs are built once and no
    self-join is needed."""
    tb = [F.col(c) for c in ([tie_b] if tie_b else b_id)]
    ta = [F.col(c) for c in ([tie_a] if tie_a else a_id)]
    wa = Window.partitionBy(*a_id).orderBy(F.col(score).desc(), *tb)
    wb = Window.partitionBy(*b_id).orderBy(F.col(score).desc(), *ta)
    ranked = (pairs.withColumn("_ra", F.row_number().over(wa))
              .withColumn("_rb", F.row_number().over(wb)))
    return ranked.where((F.col("_ra") == 1) & (F.col("_rb") == 1)).drop("_ra", "_rb")
