"""Helpers shared by the text operators.

``map_columns``   Arrow batches through a Python function, some columns in,
                  some columns out (the whole input row can ride along).
``sieve``         a bitmap over a fixed number of bits that says which rows
                  may have a key in a set. Its size does not depend on the
                  set, so it may be broadcast; a row it lets through is then
                  checked exactly, so results never depend on it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: The characters the contracts call white space.
BLANK = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

#: Bits of one row of a sieve (fixed by Spark's bitmap functions).
SIEVE_ROW_BITS = 32768


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(text_col: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(text_col), F.lit(""))


def row_key(*cols: str) -> Column:
    """64-bit hash of the named columns; defined for nulls."""
    return F.xxhash64(*cols)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that no column of the input has."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def small_batches(spark: SparkSession, rows: int = 1024, size: int = 8 << 20) -> None:
    """Limit the session's Arrow batches; smaller limits stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key).rstrip("bB")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def map_columns(df: DataFrame, fn: Callable[..., list], inputs: list[str],
                outputs: list[StructField], keep: list[str] | None = None,
                setup: Callable[[], object] | None = None, rows: int = 512) -> DataFrame:
    """``keep`` columns of ``df`` (all by default) plus the columns that
    ``fn`` makes of the ``inputs``. An output whose name a kept column has
    gets underscores in front (``fresh``).

    ``fn(state, *arrays)`` gets Arrow arrays of at most ``rows`` rows and
    returns one array or list for each output; ``state`` is what ``setup``
    returned, built once in a task. Spark's own batches are kept small, in
    rows and in bytes, so a task holds little whatever the length of the
    texts, and what Arrow has pooled is given back when the task ends.
    """
    small_batches(df.sparkSession)
    keep = list(df.columns) if keep is None else keep
    taken = list(keep)
    for i, f in enumerate(outputs):
        outputs = [*outputs[:i], StructField(fresh(f.name, taken), f.dataType, f.nullable), *outputs[i + 1:]]
        taken.append(outputs[i].name)
    out = StructType([df.schema[c] for c in keep] + outputs)
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(f.dataType) for f in outputs]
    names = [f.name for f in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                b = whole.slice(at, rows)
                made = fn(state, *[b.column(c) for c in inputs])
                made = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=k)
                        for x, k in zip(made, kinds)]
                made = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in made]
                yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + made, names=keep + names)
        pa.default_memory_pool().release_unused()

    need = list(dict.fromkeys([*keep, *inputs]))
    return df.select(*need).mapInArrow(run, out)


def sieve(keys: DataFrame, key: str, bits: int = 1 << 24) -> DataFrame:
    """Bitmap of the hashed ``key`` values: at most ``bits / 32768`` rows of
    4 KiB (2 MiB at the default), whatever the number of keys."""
    p = F.pmod(F.xxhash64(key), F.lit(bits))
    return (keys.select(p.alias("p"))
            .groupBy(F.expr(f"p div {SIEVE_ROW_BITS}").alias("sieve_row"))
            .agg(F.expr(f"bitmap_construct_agg(p % {SIEVE_ROW_BITS})").alias("sieve_bits")))


def sift(df: DataFrame, key: str, bitmap: DataFrame, bits: int = 1 << 24) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` may be in the set, rows whose key is not).

    The bitmap is bounded by ``bits / 8`` bytes and so is broadcast; the
    rows themselves do not move."""
    taken = df.columns
    p, r, w = (fresh(c, taken) for c in ("sieve_p", "sieve_r", "sieve_w"))
    b = F.broadcast(bitmap.select(F.col("sieve_row").alias(r), F.col("sieve_bits").alias(w)))
    at = df.withColumn(p, F.pmod(F.xxhash64(key), F.lit(bits)))
    at = at.join(b, F.expr(f"{p} div {SIEVE_ROW_BITS}") == F.col(r), "left")
    bit = F.expr(f"(conv(hex(substring({w}, cast(({p} % {SIEVE_ROW_BITS}) div 8 as int) + 1, 1)), 16, 10)"
                 f" >> cast({p} % 8 as int)) & 1")
    hit = F.coalesce(bit == 1, F.lit(False))
    return at.where(hit).select(*taken), at.where(~hit).select(*taken)


def without_keys(df: DataFrame, key: str, drop: DataFrame, drop_key: str, bits: int = 1 << 24,
                 same: dict[str, str] | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``drop``. Only the rows that
    the sieve lets through are shuffled for the exact anti-join. Of a key
    that is a hash, ``same`` names the columns of ``df`` and of ``drop`` that
    must be equal too (nulls to nulls), so a collision loses no row."""
    k = fresh("drop_key", df.columns)
    also = {c: fresh(f"drop_same_{i}", df.columns) for i, c in enumerate(same or {})}
    gone = drop.select(F.col(drop_key).alias(k), *[F.col(same[c]).alias(n) for c, n in also.items()])
    gone = gone.where(F.col(k).isNotNull())
    maybe, sure = sift(df, key, sieve(gone, k, bits), bits)
    on = maybe[key] == gone[k]
    for c, n in also.items():
        on = on & maybe[c].eqNullSafe(gone[n])
    return sure.unionByName(maybe.join(gone, on, "left_anti"))
