"""Load and previous-hour features (W1–W3, M1) and category capping.

Scale design: the per-row window ``count() OVER (PARTITION BY day, hour)``
would send every row of a day to one task — a hot day would hold a third of
the data in one task. Instead the fact is pre-aggregated to one row per
(day, hour) (partial aggregation, map-side combine), the three features are
computed on that small table (≤ 24 rows per day), the table is persisted,
its row count checked, and it is broadcast back to the fact rows. The fact is
never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuo import config as C
from punctuo.config import DEFAULTS, Params
from punctuo.operators.util import materialize, sized_broadcast


def hourly_table(df: DataFrame, day: str = "day", hour: str = "hour", delay: str = "delay_min") -> DataFrame:
    """One row per (day, hour): hour_load (row count, W1), day_load (W2) and the
    previous hour's mean delay on the same day (W3: hour − 1, not ``lag``)."""
    h = df.groupBy(day, hour).agg(F.count(F.lit(1)).alias("hour_load"), F.avg(delay).alias("_hour_avg"))
    by_day = Window.partitionBy(day)
    prev = by_day.orderBy(hour).rangeBetween(-1, -1)
    return (h.withColumn("day_load", F.sum("hour_load").over(by_day))
             .withColumn("prev_hour_delay", F.max("_hour_avg").over(prev))
             .drop("_hour_avg"))


def add_load_features(df: DataFrame, params: Params = DEFAULTS, which=("hour_load", "day_load", "prev_hour_delay"),
                      day: str = "day", hour: str = "hour", delay: str = "delay_min") -> DataFrame:
    """W1 + W2 + W3 on every row (M1), via the checked broadcast of ``hourly_table``."""
    h = hourly_table(df, day, hour, delay).select(day, hour, *which)
    h = sized_broadcast(materialize(h), params.broadcast_max_rows)
    return df.join(h, [day, hour], "left").select(*df.columns, *which)


def day_counts(df: DataFrame, day: str = "day", name: str = "day_load") -> DataFrame:
    """W2 on a selection: flights per day (one row per day)."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias(name))


def top_categories(df: DataFrame, cols=C.CATEGORICAL, k: int = C.MAX_CATEGORIES) -> DataFrame:
    """T5: the ``k`` most frequent non-NULL values per column (ties by value).

    All columns in one pass: unpivot to (column, value), aggregate with
    map-side combine, rank inside each column's (small) value table."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.column_name", "kv.value").filter(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column_name").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def encode_other(df: DataFrame, top: DataFrame, cols=C.CATEGORICAL, other: str = C.OTHER,
                 params: Params = DEFAULTS) -> DataFrame:
    """Values outside the top list (and NULL) become ``other``.

    The top list has at most k rows per column, so it is broadcast after a
    size check; one broadcast hash join per column, all in one stage."""
    top = sized_broadcast(materialize(top.select("column_name", "value")), params.broadcast_max_rows)
    out = df
    for c in cols:
        t = top.filter(F.col("column_name") == c).select(F.col("value").alias(f"_top_{c}"))
        out = out.join(t, out[c].cast("string") == t[f"_top_{c}"], "left")
    return out.select(*[F.coalesce(F.col(f"_top_{c}"), F.lit(other)).alias(c) if c in cols else F.col(c)
                        for c in df.columns])
