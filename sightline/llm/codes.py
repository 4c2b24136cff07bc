"""Vector codes: a codebook a part, fitted in whole numbers with bounds.

Components become integers, floor(``scale`` x); vectors are cut into equal
consecutive parts, and each part is coded by the nearest of its codebook's
entries. The codebooks are fitted by rounds of assignment and replacement.
After the first round most distances need not be looked at again: with
Drake and Hamerly's adaptive bounds, a written table keeps for each part of
each row its ``b`` closest entries, a lower bound for each from the second
on, in order, and one outer bound for all other entries. When the entries
move, the bounds fall by what theirs moved, the outer one by the largest
move. The distance to the own entry is taken anew, and the number ``z`` of
entries that the bounds cannot tell from it says what to do: one, and the
row is certain; up to b, and these are compared; else all are. All
comparisons are of exact integers, ties to the lower index, and bounds are
rounded away from the decision, so the result is that of full search. The
rounds count the z of all rows, and b shrinks to what nearly all need.

A round is one pass over the written rows, without a shuffle of vectors:
tasks write the rows with their new bounds, and beside them one row of sums
a task, which are added up by place; only these totals, of the codebooks'
size, reach the driver. The table of the round before is deleted then.

Defined cases: null vectors and those that hold null or non-finite
components are left out; components beyond +-sqrt(2^61 / length) are held to
that, so that an error fits a long; vectors of each length have codebooks of
their own, and parts differ by one component where the length cannot be cut
evenly (an empty vector has empty parts, all at distance 0 of entry 0);
fewer ids than entries give fewer entries; an id that repeats gives one
entry, its least vector; a null id sorts after the others; rows that repeat
count as often as they are there; other columns may have any name; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType)

from sightline.llm.common import small_batches
from sightline.session import materialize, scratch_path

#: Bounds are widened by this share before they decide.
_SLACK = 1e-9


def usable(vec: Column) -> Column:
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(ok, F.lit(False))


def whole_numbers(vec: Column, scale: int) -> Column:
    """floor(scale x) of each component, held to what keeps sums of squared
    differences within a long."""
    most = F.floor(F.sqrt(F.lit(float(1 << 61)) / F.greatest(F.size(vec), F.lit(1)))) - 1
    most = F.least(most, F.lit(2 ** 31 - 1)).cast("double")
    return F.transform(vec.cast("array<double>"),
                       lambda x: F.floor(F.greatest(-most, F.least(most, x * scale))).cast("int"))


def cuts(length: int, parts: int) -> list[slice]:
    return [slice(i * length // parts, (i + 1) * length // parts) for i in range(parts)]


# one part of one batch, in numpy ------------------------------------------

def squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    x, book = x.astype(np.int64), book.astype(np.int64)
    most = max(int(np.abs(a).max(initial=0)) for a in (x, book))
    if 4 * x.shape[1] * most * most < 1 << 52:               # every step is a whole double
        xf, bf = x.astype(np.float64), book.astype(np.float64)
        d = (xf * xf).sum(axis=1)[:, None] + (bf * bf).sum(axis=1) - 2 * (xf @ bf.T)
        return d.astype(np.int64)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in book], axis=1)


def _sorted_near(d: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries and their distances by distance, then index."""
    by_index = np.argsort(near, axis=1)
    near, d = np.take_along_axis(near, by_index, 1), np.take_along_axis(d, by_index, 1)
    by_distance = np.argsort(d, axis=1, kind="stable")
    return np.take_along_axis(near, by_distance, 1), np.take_along_axis(d, by_distance, 1)


def search_all(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(b closest entries, bounds, error) by full search. ``bounds`` has the
    lower bounds of the entries from the second on, then the outer bound."""
    d = squares(x, book)
    near = np.argpartition(d, b - 1, axis=1)[:, :b] if b < d.shape[1] else np.tile(np.arange(d.shape[1]), (len(d), 1))
    first = d.argmin(axis=1)
    lost = (near != first[:, None]).all(axis=1)                # more ties than places
    near[lost, -1] = first[lost]
    near, close = _sorted_near(np.take_along_axis(d, near, 1), near)
    others = d.astype(np.float64)
    np.put_along_axis(others, near, np.inf, axis=1)
    bounds = np.sqrt(np.concatenate([close[:, 1:].astype(np.float64), others.min(axis=1, initial=np.inf)[:, None]], axis=1))
    return near, np.minimum.accumulate((bounds * (1 - _SLACK))[:, ::-1], axis=1)[:, ::-1], close[:, 0]


def search_bounded(x: np.ndarray, book: np.ndarray, near: np.ndarray, bounds: np.ndarray, moved: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(closest entries, bounds, error, z) after the entries have ``moved``."""
    b = near.shape[1]
    x, book = x.astype(np.int64), book.astype(np.int64)
    fall = np.concatenate([moved[near[:, 1:]], np.full((len(x), 1), moved.max(initial=0.0))], axis=1)
    bounds = np.maximum(np.minimum.accumulate((bounds - fall)[:, ::-1], axis=1)[:, ::-1], 0.0)
    error = ((x - book[near[:, 0]]) ** 2).sum(axis=1)
    own = np.sqrt(error.astype(np.float64)) * (1 + _SLACK)
    z = 1 + (bounds <= own[:, None]).sum(axis=1)
    near, bounds = near.copy(), bounds.copy()
    width = 2
    while width < 2 * b:                                     # doubtful among the first z entries
        w = min(width, b)
        at = np.flatnonzero((z > width // 2) & (z <= w) & (z > 1))
        if len(at):
            some = near[at, :w]
            d = ((x[at, None, :] - book[some]) ** 2).sum(axis=2)
            near[at, :w], d = _sorted_near(d, some)
            low = np.sqrt(d[:, 1:].astype(np.float64)) * (1 - _SLACK)
            bounds[at, :w - 1] = np.minimum(low, bounds[at, w - 1][:, None])
            error[at] = d[:, 0]
        width *= 2
    at = np.flatnonzero(z > b)
    if len(at):
        near[at], bounds[at], error[at] = search_all(x[at], book, b)
    return near, bounds, error, z


def pack_bounds(bounds: np.ndarray) -> np.ndarray:
    """The upper half of 32-bit floats, which rounds down."""
    down = np.nextafter(bounds.astype(np.float32), np.float32(0))
    return (np.where(np.isinf(bounds), np.float32(np.inf), down).view(np.uint32) >> 16).astype("<u2")


def unpack_bounds(packed: np.ndarray) -> np.ndarray:
    return (packed.astype(np.uint32) << 16).view(np.float32).astype(np.float64)


# rounds -------------------------------------------------------------------

class Codebooks:
    """Entries of each part for each vector length, with what they moved last."""

    def __init__(self, books: dict[int, list[np.ndarray]], parts: int):
        self.books, self.parts = books, parts
        self.moved = {n: [np.zeros(len(b)) for b in bs] for n, bs in books.items()}

    def replaced(self, totals: dict[int, np.ndarray]) -> "Codebooks":
        """Entries become the componentwise floor of their parts' mean."""
        new: dict[int, list[np.ndarray]] = {}
        for n, books in self.books.items():
            flat, at, new[n] = totals[n], 0, []
            for old in books:
                k, d = old.shape
                sums, counts = flat[at:at + k * d].reshape(k, d), flat[at + k * d:at + k * d + k]
                at += k * d + k
                book = old.copy()
                used = counts > 0
                book[used] = (sums[used] // counts[used][:, None]).astype(np.int64)
                new[n].append(book)
        out = Codebooks(new, self.parts)
        for n in new:
            out.moved[n] = [np.sqrt(((a - b).astype(np.float64) ** 2).sum(axis=1)) * (1 + _SLACK)
                            for a, b in zip(new[n], self.books[n])]
        return out

    def digest(self, length: int) -> str:
        flat = [str(v) for book in self.books[length] for v in book.ravel().tolist()]
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def _row_bytes(a: np.ndarray) -> list[bytes]:
    a = np.ascontiguousarray(a)
    step, raw = a.shape[1] * a.itemsize, a.tobytes()
    return [raw[i * step:(i + 1) * step] for i in range(len(a))]


def _assign(rows: DataFrame, keep: list[str], books: Codebooks, b: int, first: bool, last: bool, spec: StructType) -> DataFrame:
    """One pass: rows with new bounds and a row of sums a task and length, or
    (``last``) rows with code and error."""
    parts = books.parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        seen = {n: np.zeros(257 + 1, dtype=np.int64) for n in books.books}
        for whole in batches:
            lengths = whole.column("length").to_numpy()
            for n in np.unique(lengths).tolist():
                batch = whole.take(pa.array(np.flatnonzero(lengths == n))) if (lengths != n).any() else whole
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), n)
                near_out, bounds_out, code, error = [], [], [], np.zeros(len(batch), dtype=np.int64)
                if not first:
                    near_in = np.frombuffer(b"".join(batch.column("near").to_pylist()), dtype=np.uint8)
                    near_in = near_in.reshape(len(batch), parts, -1).astype(np.int64)
                    bounds_in = np.frombuffer(b"".join(batch.column("bounds").to_pylist()), dtype="<u2")
                    bounds_in = unpack_bounds(bounds_in).reshape(len(batch), parts, -1)
                for p, cut in enumerate(cuts(n, parts)):
                    book, part = books.books[n][p], x[:, cut]
                    if first:
                        near, bounds, e = search_all(part, book, min(b, len(book)))
                    else:
                        near, bounds, e, z = search_bounded(part, book, near_in[:, p], bounds_in[:, p], books.moved[n][p])
                        seen[n] += np.bincount(np.minimum(z, 257), minlength=258)
                        if b < near.shape[1]:
                            near, bounds = near[:, :b], bounds[:, :b]
                    own = near[:, 0]
                    error += e
                    code.append(own.astype(np.uint8))
                    if not last:
                        near_out.append(near.astype(np.uint8))
                        bounds_out.append(pack_bounds(bounds))
                        k, d = book.shape
                        total = sums.setdefault(n, [np.zeros(s.size + len(s), dtype=np.int64) for s in books.books[n]])[p]
                        for j in range(d):
                            total[:k * d].reshape(k, d)[:, j] += np.bincount(
                                own, weights=part[:, j], minlength=k).astype(np.int64)
                        total[k * d:] += np.bincount(own, minlength=k)
                cols = [batch.column(c) for c in keep]
                if last:
                    cols += [pa.array([r.hex() for r in _row_bytes(np.stack(code, axis=1))], type=pa.string()),
                             pa.array(error), batch.column("length")]
                else:
                    cols += [batch.column("length"), batch.column("v"),
                             pa.array(_row_bytes(np.concatenate(near_out, axis=1)), type=pa.binary()),
                             pa.array(_row_bytes(np.concatenate(bounds_out, axis=1)), type=pa.binary()),
                             pa.nulls(len(batch), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=spec.names)
        for n, total in sums.items():
            flat = np.concatenate([*total, seen[n]])
            nothing = [pa.nulls(1, c.type) for c in cols[:len(keep)]]
            yield pa.RecordBatch.from_arrays(
                [*nothing, pa.array([n], type=pa.int32()), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.binary()),
                 pa.nulls(1, pa.binary()), pa.array([flat.tolist()], type=pa.list_(pa.int64()))], names=spec.names)
    return rows.mapInArrow(run, spec)


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def first_books(rows: DataFrame, id_col: str, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors of the least ids, for each length. Only
    narrow rows are ranked, with a limit before the shuffle, and at most
    ``entries`` vectors a length reach the driver."""
    ids = rows.select("length", F.col(id_col).alias("id")).distinct()
    rank = F.row_number().over(Window.partitionBy("length").orderBy(F.col("id").asc_nulls_last()))
    ids = ids.withColumn("rank", rank).where(F.col("rank") <= entries)
    ids = ids.select(F.col("length").alias("of_length"), "id", "rank")
    found = (rows.join(F.broadcast(ids), (F.col("length") == F.col("of_length")) & F.col(id_col).eqNullSafe(F.col("id")))
             .groupBy("length", "rank").agg(F.min("v").alias("v")).collect())
    books: dict[int, list[np.ndarray]] = {}
    for n in sorted({r["length"] for r in found}):
        least = [r["v"] for r in sorted((r for r in found if r["length"] == n), key=lambda r: r["rank"])]
        x = np.array(least, dtype=np.int64).reshape(len(least), n)
        books[n] = [x[:, c] for c in cuts(n, parts)]
    return Codebooks(books, parts)


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", keep: list[str] | None = None,
                 parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, b: int | None = None,
                 share: float = 0.99) -> tuple[DataFrame, Codebooks]:
    """(``keep`` columns, code, error, length) of every usable vector, written, and
    the codebooks. ``b`` entries a part have bounds at first (an eighth of
    the entries); it shrinks to what ``share`` of the rows needed in the last
    round, but not below two."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte a part")
    spark = vectors.sparkSession
    small_batches(spark, rows=2048)
    keep = [id_col] if keep is None else keep
    taken = {c.lower() for c in keep}
    clash = taken & {"length", "v", "near", "bounds", "sums", "code", "error"}
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")
    rows = materialize(vectors.where(usable(F.col(vec_col))).select(
        *keep, F.size(vec_col).alias("length"), whole_numbers(F.col(vec_col), scale).alias("v")), "vectors")
    books = first_books(rows, id_col, parts, entries)
    own = [rows.schema[c] for c in keep]
    state = StructType([*own, StructField("length", IntegerType()), StructField("v", ArrayType(IntegerType())),
                        StructField("near", BinaryType()), StructField("bounds", BinaryType()),
                        StructField("sums", ArrayType(LongType()))])
    final = StructType([*own, StructField("code", StringType()), StructField("error", LongType()),
                        StructField("length", IntegerType())])
    b = max(2, entries // 8) if b is None else b
    before = None
    for r in range(rounds):
        path = scratch_path(spark, f"tables/codes-{uuid.uuid4().hex}")
        _assign(rows, keep, books, b, r == 0, False, state).write.parquet(path)
        if before:
            _delete(spark, before)
        written, before = spark.read.schema(state).parquet(path), path
        places = (written.where(F.col("sums").isNotNull()).select("length", F.posexplode("sums"))
                  .groupBy("length", "pos").agg(F.sum(F.col("col").cast("decimal(20,0)")).alias("total")).collect())
        totals: dict[int, np.ndarray] = {}
        for n, group in books.books.items():
            totals[n] = np.zeros(sum(x.size + len(x) for x in group) + 258, dtype=object)
        for row in places:
            totals[row["length"]][row["pos"]] = int(row["total"])
        books = books.replaced(totals)
        if r:
            needed = np.cumsum(sum(t[-258:] for t in totals.values()))
            b = max(2, min(b, int(np.argmax(needed >= share * needed[-1])))) if len(needed) and needed[-1] else b
        rows = written.where(F.col("sums").isNull()).drop("sums")
    out = materialize(_assign(rows, keep, books, b, rounds == 0, True, final), "vector-codes")
    if before:
        _delete(spark, before)
    return out, books


def with_group_error(codes: DataFrame, books: Codebooks, group_col: str = "label") -> DataFrame:
    """``codes`` with the summed error of their group (nulls are a group; null
    where the sum does not fit a long) and the digest of their codebooks."""
    sums = codes.groupBy(F.col(group_col).alias("of_group")).agg(
        F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long").alias("group_error"))
    digests = codes.sparkSession.createDataFrame([(n, books.digest(n)) for n in books.books],
                                                 "of_length int, codebooks_sha256 string")
    return (codes.join(sums, F.col(group_col).eqNullSafe(F.col("of_group")))
            .join(F.broadcast(digests), F.col("length") == F.col("of_length")))
