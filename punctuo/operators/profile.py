"""Profiles and source checks.

The column profile avoids Spark's multi-distinct rewrite (which expands every
row once per distinct aggregate): rows are unpivoted to (column, value),
counted with map-side combine, and every metric is read off that small
(column, value, n) table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuo import config as C
from punctuo.functions import columns as X


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def value_counts_long(df: DataFrame, cols: Sequence[str] | None = None, order: str | None = None) -> DataFrame:
    """(column_name, value, n) for every column, one aggregation; with ``order``, a column
    that orders the rows, also ``first``, its smallest value among the rows counted."""
    cols = list(cols or [c for c in df.columns if c != order])
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _q(c).cast("string").alias("value")) for c in cols])).alias("kv")
    extra = [_q(order).alias("_at")] if order else []
    long = df.select(kv, *extra).select("kv.column_name", "kv.value", *[F.col("_at") for _ in extra])
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"), *[F.min("_at").alias("first") for _ in extra])


def column_profile(df: DataFrame, tokens: Sequence[str] = C.FLIGHT_NULL_TOKENS, order: str | None = None) -> DataFrame:
    """Per column distinct values, count per marker, % empty, an example.

    'Empty' is NULL or a marker (Spark reads an empty cell as NULL). ``order``: a column
    that orders the rows, as ``sources.files.file_order`` gives it; the example is then
    the first row's value, NULL if its cell is. Without it, the smallest value."""
    vc = value_counts_long(df, order=order)
    v = F.col("value")
    markers = [t for t in tokens if t]
    empty = v.isNull() | v.isin(list(tokens))
    aggs = [F.count(v).alias("n_distinct")]
    aggs += [F.coalesce(F.sum(F.when(v == t, F.col("n"))), F.lit(0)).alias(f"n_{_slug(t)}") for t in markers]
    aggs += [(F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)) * F.lit(100.0) / F.sum("n")).alias("empty_pct"),
             (F.min_by(v, "first") if order else F.min(v)).alias("example")]
    return vc.groupBy("column_name").agg(*aggs)


def _slug(token: str) -> str:
    return {"-": "dash", "#N/A": "na", "\\N": "backslash_n"}.get(token, "".join(ch for ch in token if ch.isalnum()).lower())


def null_profile(df: DataFrame, reasons: dict[str, str] | None = None, default_reason: str | None = None) -> DataFrame:
    """NULL count and % per column (one aggregation, then one row per column),
    with an optional reason label per column (``default_reason`` for the rest)."""
    n = F.count(F.lit(1))
    agg = df.agg(n.alias("_rows"), *[F.count_if(_q(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_null_{i}").alias("n_null"))
                     for i, c in enumerate(df.columns)])
    out = (agg.select(F.col("_rows"), F.inline(rows))
              .select("column_name", "n_null", (F.col("n_null") * F.lit(100.0) / F.col("_rows")).alias("null_pct")))
    if reasons is None and default_reason is None:
        return out
    lab = X.map_codes("column_name", reasons or {"": ""}, default=default_reason)
    return out.withColumn("reason", lab)


def value_freq(df: DataFrame, c: str) -> DataFrame:
    """Value frequencies (NULL excluded, like ``value_counts``)."""
    return df.filter(_q(c).isNotNull()).groupBy(_q(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def source_summary(df: DataFrame, day: str = "day") -> DataFrame:
    """Rows, first/last day, calendar days expected in between, days missing."""
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
                 F.count_distinct(day).alias("_days"))
    expected = F.datediff("last_day", "first_day") + 1
    return agg.select("n_rows", "first_day", "last_day", expected.alias("expected_days"),
                      (expected - F.col("_days")).alias("missing_days"))


def suspect_period(df: DataFrame, measure: str, start: str, day: str = "day") -> DataFrame:
    """Days from ``start`` on, mean of ``measure`` inside and outside."""
    inside = F.col(day) >= F.to_date(F.lit(start))
    return df.agg(F.count_if(inside).alias("suspect_days"),
                  F.avg(F.when(inside, F.col(measure))).alias("mean_inside"),
                  F.avg(F.when(~inside, F.col(measure))).alias("mean_outside"))


def null_suspect(df: DataFrame, measure: str, start: str, day: str = "day") -> DataFrame:
    """The measure set to NULL from ``start`` on."""
    return df.withColumn(measure, X.null_from(measure, day, start))


def coverage(df: DataFrame, conds: dict[str, Column]) -> DataFrame:
    """% of rows meeting each condition (one aggregation)."""
    return df.agg(*[(F.avg(F.coalesce(c, F.lit(False)).cast("double")) * 100).alias(name) for name, c in conds.items()])
