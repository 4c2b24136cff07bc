"""Angles between vectors as a metric: pruned pairs and a stored index
(J5, V3, L5, V11).

The angle between two vectors obeys the triangle inequality, so what lies
near a vector can be told from its distances to a few pivots. Pivots are
chosen farthest-first from a bounded sample; every vector belongs to the
cell of its nearest pivot.

``blocks``        a table of one row for some thousand vectors of a cell.
``near_pairs``    pairs within an angle. A cell is a ball around its pivot;
                  blocks are compared, where they lie, with the blocks of
                  the cells that can be reached within the angle, and of
                  those with the vectors that can. What moves through
                  shuffles is one copy of each vector.
``near_groups``   the same cells for a join by key: a vector is copied to
                  the cells whose ball it can reach.
``build_index``   a table of shells (cell, ring of angles to the pivot) with
                  their least and greatest angle.
``search_index``  the k most similar vectors of each query: shells are read
                  in the order of their bounds until no unread shell of a
                  query can hold a better one, so the answer is exact.

Pruning saves what the data allow: clustered vectors meet few cells, vectors
without structure meet nearly all of them, and then the cost is that of a
full comparison.

Vectors that are null, empty, zero or hold null or non-finite components
have no direction and take no part, nor do those whose length is not the
usual one (the most common, the smaller of equals). Bounds are widened by
``SLACK`` before they decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DataType, DoubleType, IntegerType, LongType, StructField,
                               StructType)

from sightline.operators.stats import keep_n
from sightline.session import materialize, scratch_path

#: Radians by which a bound is widened.
SLACK = 1e-6


def _with(df: DataFrame, **more: DataType) -> StructType:
    return StructType([*df.schema.fields, *[StructField(n, t) for n, t in more.items()]])


def has_direction(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def usable(vecs: DataFrame, vec_col: str, length: int | None = None) -> DataFrame:
    """The rows whose vector has a direction and the usual length."""
    ok = vecs.where(has_direction(F.col(vec_col)))
    if length is None:
        sizes = ok.groupBy(F.size(vec_col).alias("s")).agg(F.count(F.lit(1)).alias("n"))
        top = sizes.orderBy(F.col("n").desc(), "s").first()
        length = top["s"] if top else 0
    return ok.where(F.size(vec_col) == length)


def unit(column) -> np.ndarray:
    """Rows of unit length. Scaling by powers of two first keeps squares
    from overflowing."""
    m = np.stack([np.asarray(x, dtype=np.float64) for x in column])
    m = np.ldexp(m, -np.frexp(np.abs(m).max(axis=1, keepdims=True))[1])
    return m / np.sqrt((m * m).sum(axis=1))[:, None]


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def choose_pivots(vecs: DataFrame, n: int, id_col: str = "_id", vec_col: str = "_v", sample: int = 8192) -> np.ndarray:
    """At most ``n`` unit vectors, farthest-first from the ``sample`` rows
    whose ids hash lowest. Any choice gives right results; a good one prunes."""
    got = vecs.select(F.xxhash64(id_col).alias("h"), F.col(vec_col).alias("v")).orderBy("h", "v").limit(sample).toPandas()
    if not len(got):
        return np.zeros((0, 0))
    x = unit(got["v"])
    chosen = [0]
    far = angles(x, x[:1])[:, 0]
    while len(chosen) < min(n, len(x)) and far.max() > SLACK:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, angles(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def place(vecs: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vecs`` (with ``_v``) with the nearest pivot ``_home`` and the angle
    to it."""
    schema = _with(vecs, _home=IntegerType(), _angle=DoubleType())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                a = angles(unit(b["_v"]), pivots)
                home = a.argmin(axis=1)
                yield b.assign(_home=home.astype(np.int32), _angle=a[np.arange(len(a)), home])
    return vecs.mapInPandas(run, schema)


# pairs --------------------------------------------------------------------

def near_groups(placed: DataFrame, pivots: np.ndarray, reach: float, tile_size: int) -> DataFrame:
    """The rows of ``placed`` copied to the groups ``(_cell, _g_lo, _g_hi)``
    in which they may meet others within ``reach``: every such pair is in
    exactly one group, in the tiles ``_g_lo`` and ``_g_hi``. Tiles of rows at
    home come first, then those of guests, which need not meet each other."""
    spark = placed.sparkSession
    radius = np.zeros(len(pivots))
    for r in placed.groupBy("_home").agg(F.max("_angle").alias("r")).collect():      # one row a pivot
        radius[r["_home"]] = r["r"]

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            a = angles(unit(b["_v"]), pivots)
            home, own = b["_home"].to_numpy(), b["_angle"].to_numpy()
            cell = np.arange(len(pivots))
            # inside the ball's reach, and not further than the nearest pivot allows
            goes = (cell < home[:, None]) & (a <= radius + reach + SLACK) & (a - own[:, None] <= 2 * reach + SLACK)
            yield b.assign(_cells=[np.concatenate([[h], np.flatnonzero(g)]).astype(np.int32) for h, g in zip(home, goes)])
    keep = [c for c in placed.columns if c not in ("_home", "_angle")]
    visiting = placed.mapInPandas(visits, _with(placed, _cells=ArrayType(IntegerType())))
    rows = visiting.select(*keep, F.posexplode("_cells").alias("_pos", "_cell"))
    counts = (rows.groupBy("_cell").agg(F.sum((F.col("_pos") == 0).cast("long")).alias("home"),
                                        F.sum((F.col("_pos") > 0).cast("long")).alias("guests")).collect())
    tiles = spark.createDataFrame([(c["_cell"], -(-c["home"] // tile_size), -(-c["guests"] // tile_size)) for c in counts],
                                  "_cell int, _homes int, _guests int")       # one row a pivot at most
    rows = rows.withColumn("_h", F.xxhash64(F.monotonically_increasing_id())).join(F.broadcast(tiles), "_cell")
    at_home = F.col("_pos") == 0
    rows = rows.withColumn("_tile", F.when(at_home, F.pmod("_h", F.col("_homes")))
                           .otherwise(F.col("_homes") + F.pmod("_h", F.greatest("_guests", F.lit(1)))).cast("int"))
    meets = F.when(at_home, F.sequence(F.lit(0), F.col("_homes") + F.col("_guests") - 1)) \
        .otherwise(F.sequence(F.lit(0), F.col("_homes") - 1))
    return (rows.withColumn("_other", F.explode(F.when(F.col("_homes") > 0, meets)))
            .select(*keep, "_cell", "_tile", F.least("_tile", "_other").alias("_g_lo"),
                    F.greatest("_tile", "_other").alias("_g_hi")))


def blocks(rows: DataFrame, parts: list[tuple[int, int]], tile_size: int, carried: list[str]) -> DataFrame:
    """One row for each block of about ``tile_size`` rows of a ``_cell``:
    its ``_no``, ``_cell``, the unit vectors of ``_v`` (``_unit``, doubles row
    by row) and the ``carried`` columns as arrays. ``parts``: (cell, number
    of its rows); a row a cell. Written to the shared folder as files of
    several blocks, so that every task can read any of them."""
    spark = rows.sparkSession
    sizes = [(cell, max(1, -(-n // tile_size))) for cell, n in parts]
    n_blocks = sum(n for _, n in sizes) or 1
    by = spark.createDataFrame(sizes, "_cell int, _blocks int")
    cut = rows.join(F.broadcast(by), "_cell").select(
        "_cell", F.pmod(F.xxhash64("_id", "_v"), F.col("_blocks")).alias("_block"), "_v", *carried)
    schema = StructType([StructField("_no", LongType()), StructField("_cell", IntegerType()), StructField("_unit", BinaryType())]
                        + [StructField(c, ArrayType(rows.schema[c].dataType)) for c in carried])

    def pack(key, pdf):
        arrays = {c: [[None if pd.isna(x) else x for x in pdf[c]] if pdf[c].isna().any() else pdf[c].to_numpy()]
                  for c in carried}
        return pd.DataFrame({"_no": [(int(key[0]) << 32) + int(key[1])], "_cell": [key[0]],
                             "_unit": [unit(pdf["_v"]).tobytes()], **arrays})
    files = min(n_blocks, max(16, n_blocks // 32))
    packed = cut.repartition(files, "_cell", "_block").groupBy("_cell", "_block").applyInPandas(pack, schema)
    return materialize(packed, "blocks")


def block_pairs(a: DataFrame, b: DataFrame, where: Column | None = None) -> DataFrame:
    """Every block of ``a`` beside every block of ``b``: columns ``a_...`` and
    ``b_...``. Both tables are dealt to ``_GRID`` parts; a part is copied to
    the tasks of all parts of the other, so ``_GRID`` copies of each vector
    move, whatever the number of blocks."""
    deal = F.sequence(F.lit(0), F.lit(_GRID - 1))
    sides = []
    for df, p, own, other in ((a, "a", "_l", "_r"), (b, "b", "_r", "_l")):
        df = df.select(*[F.col(c).alias(p + c) for c in df.columns])
        df = df.withColumn(own, F.pmod(F.xxhash64(p + "_no"), F.lit(_GRID)).cast("int")).withColumn(other, F.explode(deal))
        sides.append(df.repartition(_GRID * _GRID, "_l", "_r"))
    both = sides[0].join(sides[1], ["_l", "_r"])
    return both if where is None else both.where(where)


#: Parts to which each side of ``block_pairs`` is dealt.
_GRID = 6


def unpacked(packed: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(packed, dtype=np.float64).reshape(rows, -1)


def near_pairs(vecs: DataFrame, id_col: str, vec_col: str, group_col: str | None, threshold: float,
               tile_size: int = 2048, max_pivots: int = 512, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every pair (a < b) of different ids with cosine > ``threshold``; with
    ``group_col`` only pairs from different groups. ``carry``: columns of
    ``vecs`` that come along for both ends."""
    v = usable(vecs.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"),
                           (F.col(group_col) if group_col else F.lit("")).alias("_grp"),
                           *[F.col(c).alias(f"_x{i}") for i, c in enumerate(carry)]).where("_id IS NOT NULL"), "_v")
    carried = ["_id", "_grp", *[f"_x{i}" for i in range(len(carry))]]
    sides = [(c, v.schema[c].dataType) for c in carried]
    schema = StructType([StructField(p + c, t) for c, t in sides for p in "ab"] + [StructField("sim", DoubleType())])
    shown = {"_id": id_col, "_grp": group_col, **{f"_x{i}": c for i, c in enumerate(carry)}}
    names = [F.col(p + c).alias(f"{shown[c]}_{p}") for c, _ in sides for p in "ab" if shown[c]]
    pivots = choose_pivots(v, min(max_pivots, max(1, math.ceil(2 * v.count() / tile_size))))
    if not len(pivots):
        return vecs.sparkSession.createDataFrame([], schema).select(*names, "sim")
    reach = math.acos(max(-1.0, min(1.0, threshold)))
    placed = materialize(place(v, pivots), "placed")
    cells = placed.groupBy("_home").agg(F.count(F.lit(1)).alias("n"), F.max("_angle").alias("r")).collect()  # one row a pivot
    radius = np.full(len(pivots), -math.inf)
    for c in cells:
        radius[c["_home"]] = c["r"]
    table = blocks(placed.withColumnRenamed("_home", "_cell"), [(c["_home"], c["n"]) for c in cells], tile_size, carried)
    near = angles(pivots, pivots) <= radius[:, None] + radius[None, :] + reach + SLACK
    reached = vecs.sparkSession.createDataFrame(
        [(i, [int(j) for j in np.flatnonzero(row)]) for i, row in enumerate(near)], "_cell int, _near array<int>")
    meets = (F.col("a_no") <= F.col("b_no")) & F.array_contains("a_near", F.col("b_cell"))
    both = block_pairs(table.join(F.broadcast(reached), "_cell"), table, meets)
    both = both.select("a_cell", "b_cell", (F.col("a_no") == F.col("b_no")).alias("same"), "a_unit", "b_unit",
                       *[p + c for c in carried for p in "ab"])

    def within(x: np.ndarray, own: int, other: int) -> np.ndarray:
        """Rows that can be near a vector of the other cell: in reach of its
        ball, and not further than the nearest pivot allows."""
        if own == other:
            return np.arange(len(x))
        a = angles(x, pivots[[own, other]])
        return np.flatnonzero((a[:, 1] <= radius[other] + reach + SLACK) & (a[:, 1] - a[:, 0] <= 2 * reach + SLACK))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                x, y = unpacked(r["a_unit"], len(r["a_id"])), unpacked(r["b_unit"], len(r["b_id"]))
                ka, kb = within(x, r["a_cell"], r["b_cell"]), within(y, r["b_cell"], r["a_cell"])
                if not len(ka) or not len(kb):
                    continue
                at = {p: {c: np.asarray(r[p + c])[k] for c in carried} for p, k in (("a", ka), ("b", kb))}
                y = y[kb]
                for start in range(0, len(ka), 1024):
                    s = x[ka[start:start + 1024]] @ y.T
                    ia, ib = np.nonzero(s > threshold)
                    sim = s[ia, ib]
                    ia += start
                    m, n = at["a"]["_id"][ia], at["b"]["_id"][ib]
                    keep = m < n if r["same"] else m != n
                    if group_col:
                        keep &= at["a"]["_grp"][ia] != at["b"]["_grp"][ib]
                    ia, ib, m, n, sim = (z[keep] for z in (ia, ib, m, n, sim))
                    if len(ia):
                        out = {}
                        for c in carried:
                            p, q = at["a"][c][ia], at["b"][c][ib]
                            out["a" + c], out["b" + c] = np.where(m < n, p, q), np.where(m < n, q, p)
                        yield pd.DataFrame({**out, "sim": sim})
    return both.mapInPandas(compare, schema).select(*names, "sim")


# the stored index -----------------------------------------------------------

def build_index(vecs: DataFrame, id_col: str, vec_col: str, path: str, pivots: int | None = None, ring: float = 0.1,
                length: int | None = None) -> None:
    """Write the index of ``vecs`` under ``path``: ``rows`` by shell, ``shells``
    with their bounds and counts, ``pivots`` (by default as many as keep a
    query's share of cells and of rows alike: a root of the rows, 512 at
    most). Rows without an id are left out."""
    spark = vecs.sparkSession
    v = usable(vecs.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v")).where("_id IS NOT NULL"), "_v", length)
    chosen = choose_pivots(v, pivots or min(512, math.isqrt(v.count()) + 1))
    rings = math.ceil(math.pi / ring) + 1
    if len(chosen):
        placed = place(v, chosen)
    else:
        placed = v.selectExpr("*", "CAST(0 AS INT) AS _home", "CAST(0 AS DOUBLE) AS _angle")
    shell = (F.col("_home") * rings + F.floor(F.col("_angle") / ring)).cast("int")
    rows = placed.select("_id", "_v", "_angle", shell.alias("shell"))
    # a shell of many rows is written by many tasks
    rows.repartition("shell", F.pmod(F.xxhash64("_id"), F.lit(16))).write.partitionBy("shell").parquet(f"{path}/rows")
    (spark.read.schema(rows.schema).parquet(f"{path}/rows").groupBy("shell")
     .agg(F.count(F.lit(1)).alias("n"), F.min("_angle").alias("near"), F.max("_angle").alias("far"))
     .withColumn("pivot", F.floor(F.col("shell") / rings).cast("int")).coalesce(1).write.parquet(f"{path}/shells"))
    spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(chosen)],
                          "pivot int, v array<double>").coalesce(1).write.parquet(f"{path}/pivots")


class _Shells:
    """The index's directory: pivots and bounds, of a size set by the number
    of pivots and rings."""

    def __init__(self, spark: SparkSession, path: str):
        p = spark.read.parquet(f"{path}/pivots").orderBy("pivot").toPandas()
        s = spark.read.parquet(f"{path}/shells").orderBy("shell").toPandas()
        self.pivots = np.stack(p["v"]) if len(p) else np.zeros((0, 0))
        self.shell, self.n = s["shell"].to_numpy(), s["n"].to_numpy()
        self.pivot, self.near, self.far = s["pivot"].to_numpy(), s["near"].to_numpy(), s["far"].to_numpy()

    def most_similar(self, q: np.ndarray) -> np.ndarray:
        """(queries, shells): the cosine that no row of a shell can pass."""
        a = angles(q, self.pivots)[:, self.pivot]
        least = np.maximum(0.0, np.maximum(a - self.far, self.near - a) - SLACK)
        return np.cos(least)


def _best(k: int):
    """Top k of a block of rows for a block of queries."""
    def run(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"q": [], "n": [], "sim": []})
        s = unit(queries["_v"]) @ unit(rows["_v"]).T
        qi, ri = queries["_q"].to_numpy(), rows["_id"].to_numpy()
        s9 = np.where(qi[:, None] == ri[None, :], -np.inf, np.round(s, 9))
        kk = min(k, s.shape[1])
        cut = np.partition(s9, -kk, axis=1)[:, -kk]
        r, c = np.nonzero((s9 >= cut[:, None]) & np.isfinite(s9))
        order = np.lexsort((ri[c], -s9[r, c], r))
        r, c = r[order], c[order]
        first = np.arange(len(r)) - np.searchsorted(r, r, side="left") < kk
        r, c = r[first], c[first]
        return pd.DataFrame({"q": qi[r], "n": ri[c], "sim": s[r, c]})
    return run


def search_index(path: str, queries: DataFrame, id_col: str, vec_col: str, k: int, block: int = 4096,
                 report: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """The k most similar rows of the index for each query row (id distinct),
    the query's own id left out, ordered as in ``identity.top_k``.

    Each round, every query reads the next shells in the order of their
    bounds, eight times as many rows as the round before, as long as they
    can hold something at least as good as its k-th best so far. ``report``
    receives (queries, shells read by any of them, shells in all) a round."""
    spark = queries.sparkSession
    at = _Shells(spark, path)
    q = queries.select(F.col(id_col).alias("_q"), F.col(vec_col).alias("_v")).where("_q IS NOT NULL")
    q = usable(q, "_v", at.pivots.shape[1])
    id_type = q.schema["_q"].dataType.simpleString()
    found_type = f"q {id_type}, n {id_type}, sim double"
    # a query's state: vector, k-th best similarity so far, shells behind it
    state = materialize(q.select("_q", "_v", F.lit(-2.0).alias("_kth"), F.lit(0).alias("_from")), "queries")
    best = spark.createDataFrame([], found_type)
    wanted = 4 * k

    def choose(wanted: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for i in range(0, len(b), 256):
                    part = b.iloc[i:i + 256]
                    most = at.most_similar(unit(part["_v"]))
                    order = np.argsort(-most, axis=1, kind="stable")
                    probes, upto = [], []
                    for j, (kth, since) in enumerate(zip(part["_kth"], part["_from"])):
                        rest = order[j, since:]
                        rest = rest[most[j, rest] + 2e-9 >= kth]
                        rows = np.cumsum(at.n[rest])
                        take = rest[:int(np.searchsorted(rows, wanted)) + 1]
                        probes.append(take.astype(np.int32))
                        upto.append(since + len(take))
                    yield part.assign(_probes=probes, _from=upto)
        return run
    while len(at.shell):
        plan = materialize(state.mapInPandas(choose(wanted), _with(state, _probes=ArrayType(IntegerType()))), "probes")
        probes = plan.select("_q", "_v", F.explode("_probes").alias("_at"))
        shells = probes.groupBy("_at").agg(F.count(F.lit(1)).alias("n")).collect()         # at most the directory
        if report is not None:
            report.append((plan.where(F.size("_probes") > 0).count(), len(shells), len(at.shell)))
        if not shells:
            break
        parts = [(s["_at"], int(at.shell[s["_at"]]), int(-(-at.n[s["_at"]] // block)), int(-(-s["n"] // block)))
                 for s in shells]

        rows = spark.read.parquet(f"{path}/rows").where(F.col("shell").isin([int(at.shell[s["_at"]]) for s in shells]))

        def dealt(df: DataFrame, on: str, own: str, other: str, salt: Column) -> DataFrame:
            by = spark.createDataFrame(parts, "_at int, shell int, _rows int, _queries int")
            df = df.join(F.broadcast(by), on)
            return (df.withColumn(own + "_no", F.pmod(salt, F.col(own)).cast("int"))
                    .withColumn(other + "_no", F.explode(F.sequence(F.lit(0), F.col(other) - 1))))
        r = dealt(rows.select("_id", "_v", "shell", F.xxhash64(F.monotonically_increasing_id()).alias("_salt")),
                  "shell", "_rows", "_queries", F.col("_salt"))
        p = dealt(probes, "_at", "_queries", "_rows", F.xxhash64("_q"))
        key = ["shell", "_rows_no", "_queries_no"]
        got = (r.groupBy(*key).cogroup(p.groupBy(*key))
               .applyInPandas(lambda key, a, b: _best(k)(key, a, b), found_type))
        ranked = keep_n(best.unionByName(got).withColumn("_s9", F.round("sim", 9)), ["q"],
                        [F.col("_s9").desc(), F.col("n")], k, "rank")
        best = materialize(ranked.select("q", "n", "sim"), "best")
        kth = best.groupBy("q").agg(F.count(F.lit(1)).alias("c"), F.min(F.round("sim", 9)).alias("s"))
        after = plan.where(F.size("_probes") > 0).drop("_probes").join(kth, F.col("_q") == F.col("q"), "left")
        state = materialize(after.select("_q", "_v", F.when(F.col("c") >= k, F.col("s")).otherwise(-2.0).alias("_kth"),
                                         "_from"), "queries")
        wanted *= 8
    best = best.withColumn("_s9", F.round("sim", 9))
    return keep_n(best, ["q"], [F.col("_s9").desc(), F.col("n")], k, "rank").select(
        F.col("q").alias(id_col), "rank", F.col("n").alias("nbr_id"), "sim")


def indexed_search(vecs: DataFrame, id_col: str, vec_col: str, queries: DataFrame, k: int, **how) -> DataFrame:
    """Build an index in the shared scratch folder and search it once."""
    import uuid
    path = scratch_path(vecs.sparkSession, f"tables/index-{uuid.uuid4().hex}")
    build_index(vecs, id_col, vec_col, path, **how)
    return search_index(path, queries, id_col, vec_col, k)
