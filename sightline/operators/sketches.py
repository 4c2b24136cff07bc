"""Sketches that are stored and united.

An hour's table holds, for each key, a HyperLogLog sketch of who was seen and
a KLL sketch of a value. Any set of hours is united into a day, a week or a
site without reading rows again, and the answer is the one that a sketch of
all their rows would give, within the same bound:

* distinct count: relative standard error 1.04 / sqrt(2^``HLL_BITS``), 0.8 %;
* quantile: the rank of the answer is off by at most about 1.7 % at
  ``KLL_K`` = 400, with 99 % confidence (half of that is usual).

Sketches are bounded by these settings, so partial aggregation sends one
small row a task and key to the shuffle, whatever the key holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^14 registers; items a KLL level holds.
HLL_BITS, KLL_K = 14, 400
#: Three standard errors of a count, and the bound of a rank.
COUNT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2), 0.017


def hourly_sketches(rows: DataFrame, keys: Sequence[str], who: Column, value: Column, ts: str = "ts") -> DataFrame:
    """(keys, hour, n, people, value_sketch). Null people and null or NaN
    values are not counted; a null time is an hour of its own."""
    v = value.cast("double")
    return (rows.withColumn("hour", F.date_trunc("hour", ts)).groupBy(*keys, "hour")
            .agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(who, F.lit(HLL_BITS)).alias("people"),
                 F.kll_sketch_agg_double(F.when(~F.isnan(v), v), F.lit(KLL_K)).alias("value_sketch")))


def unite(sketches: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """The sketches of all rows of a group, as one row of the same kind."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("people").alias("people"),
                                     F.kll_merge_agg_double("value_sketch", F.lit(KLL_K)).alias("value_sketch"))


def n_distinct(sketch: str = "people") -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile(p: float, sketch: str = "value_sketch") -> Column:
    """The value at rank ``p``; null for a sketch of no values."""
    some = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(some, F.kll_sketch_get_quantile_double(F.when(some, F.col(sketch)), F.lit(float(p))))
