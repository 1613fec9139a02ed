"""Exact quantiles and medians that stay distributed for hot groups.

Spark's exact ``percentile`` keeps a value→count map per group and merges
every map task's map for a group in ONE task: for a hot group (or a global
median) that is (map tasks × distinct values) work in one place. Here the
counting is an ordinary aggregation on (group, value), so a hot group is spread
over many reducers by value. The rank is then found by selection: a histogram per
(group, value range), the range that holds the rank, and running counts over the
distinct values of that range alone. No step brings a group's values to one place.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Value ranges an octave: a range's values differ by less than a thousandth.
RANGES_PER_OCTAVE = 1024


def bounded_array(one_row: DataFrame) -> Column:
    """Fetch a one-row array whose length is fixed by a parameter (quantile
    edges: ``groups + 1`` or ``buckets − 1`` values) and return it as a literal.

    Spark ML's QuantileDiscretizer does the same; a scalar subquery cannot be
    used here because Spark rejects subqueries inside higher-order functions."""
    values = [v for v in one_row.first()[0] or [] if v is not None]
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


# --------------------------------------------------------------------------
# selection by rank
# --------------------------------------------------------------------------
def value_range(v: Column) -> Column:
    """A number that never falls as ``v`` rises: equal for values within 2^(1/1024), whatever their size; 0 for 0.

    The logarithm of the smallest double is above -1100, so the shift keeps both signs apart."""
    place = F.floor(F.log2(F.abs(v)) * RANGES_PER_OCTAVE) + F.lit(1100 * RANGES_PER_OCTAVE)
    return F.when(v == 0, F.lit(0).cast("long")).otherwise(F.when(v < 0, -place).otherwise(place))


def _holds(ranges: Column, rank: Column) -> Column:
    """(rank, r, before): the first of ``ranges`` (sorted structs r, h) that holds the 0-based ``rank``, and how many values lie in the ones below."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("r"), F.lit(0).cast("long").alias("before"))

    def step(a, x):
        hit = a["r"].isNull() & (a["sum"] + x["h"] > rank)
        return F.struct((a["sum"] + x["h"]).alias("sum"), F.when(hit, x["r"]).otherwise(a["r"]).alias("r"), F.when(hit, a["sum"]).otherwise(a["before"]).alias("before"))

    found = F.aggregate(ranges, start, step)
    return F.struct(rank.alias("rank"), found["r"].alias("r"), found["before"].alias("before"))


def reads_all(counts: Sequence[str]) -> Column:
    """A condition that always holds and reads every count of a table: none is pruned from one use of the table alone, so all share one exchange."""
    return F.coalesce(*[F.when(F.col(c) < 0, F.lit(False)) for c in counts], F.lit(True))


def grouped_quantiles(vc: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], sums: dict[str, Column] | None = None) -> DataFrame:
    """Exact interpolated quantiles per group from value counts, with sums beside them.

    ``vc``: rows of (``keys``, ``value``) with their count ``_c`` (a value may have several
    rows, as when another column is counted beside it); NULL values are in the sums only. ``sums``: numbers of a row of ``vc`` to add up per group. Returns the
    keys, the sums and the array ``q`` (NULL without a value). Keys must not be NULL."""
    keys, sums = list(keys), sums or {}
    v = F.col(value).cast("double")
    ranged = vc.withColumn("_r", value_range(v))
    hist = ranged.groupBy(*keys, "_r").agg(F.sum(F.when(v.isNotNull(), F.col("_c"))).alias("_h"), *[F.sum(c).alias(n) for n, c in sums.items()])
    entry = F.when(F.col("_r").isNotNull(), F.struct(F.col("_r").alias("r"), F.col("_h").alias("h")))
    groups = hist.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_ranges"), F.sum("_h").alias("_m"), *[F.sum(n).alias(n) for n in sums])
    place = [(F.col("_m") - 1) * F.lit(float(p)) for p in probs]
    ends = [(F.floor(p).cast("long"), F.ceil(p).cast("long")) for p in place]
    wanted = F.when(F.col("_m") > 0, F.array_distinct(F.array(*[_holds(F.col("_ranges"), e) for pair in ends for e in pair])))
    picked = groups.select(*keys, *sums, "_m", F.explode_outer(wanted).alias("_w")).select(*keys, *sums, "_m", F.col("_w.r").alias("_r"), "_w.rank", "_w.before")
    # both uses of ``vc`` stay one plan, made once: the condition reads all counts, and null-safe keys leave no filter to push below it
    counts = [f.name for f in vc.schema.fields if f.name not in (*keys, value) and isinstance(f.dataType, T.LongType)]
    inside = ranged.filter(reads_all(counts)).select(*[F.col(f"`{k}`").alias(f"_in{i}") for i, k in enumerate(keys)], F.col("_r").alias("_in"), v.alias("_v"), "_c")
    same = F.col("_r").eqNullSafe(F.col("_in"))
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_in{i}"))
    near = picked.join(inside, same, "left")
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_r", "rank").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    near = near.withColumn("_cum", upto + F.col("before"))
    near = near.filter(F.col("rank").isNull() | ((F.col("_cum") > F.col("rank")) & (F.col("_cum") - F.col("_c") <= F.col("rank"))))
    at = lambda rank: F.max(F.when(F.col("rank") == rank, F.col("_v")))
    out = near.groupBy(*keys).agg(*[F.first(n).alias(n) for n in sums], F.first("_m").alias("_m"),
                                  *[at(e).alias(f"_{side}{i}") for i, pair in enumerate(ends) for side, e in zip("lh", pair)])
    qs = [F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * (p - F.floor(p)) for i, p in enumerate(place)]
    return out.select(*keys, *sums, F.when(F.col("_m") > 0, F.array(*qs)).alias("q"))


def exact_quantiles(df: DataFrame, c: str, probs: Sequence[float]) -> DataFrame:
    """Exact, linearly interpolated quantiles (same definition as ``percentile``)
    as one row with an array column ``q``, NULL without a value."""
    return grouped_quantiles(df.groupBy(c).agg(F.count(F.lit(1)).alias("_c")), [], c, probs)


def median_scalar(df: DataFrame, c: str) -> Column:
    """Exact (interpolated) median of a column as a scalar subquery."""
    return exact_quantiles(df, c, [0.5]).select(F.col("q")[0]).scalar()


def median_table(df: DataFrame, keys: Sequence[str], c: str, name: str = "median") -> DataFrame:
    """Exact interpolated median of ``c`` per group (``keys``, not NULL), one row
    per group that has a non-NULL value."""
    keys = list(keys)
    vc = df.filter(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count(F.lit(1)).alias("_c"))
    return grouped_quantiles(vc, keys, c, [0.5]).select(*keys, F.col("q")[0].alias(name))
