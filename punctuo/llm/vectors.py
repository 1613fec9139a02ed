"""What the two vector searches share: valid rows, blocks, arrays, and the last merge."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid(df: DataFrame, id_col: str, vec_col: str, value=lambda x: x, kind: str = "double", keep_zero: bool = True) -> DataFrame:
    """Distinct (vec_id, vec) with their number of copies.

    Rows with a null id, a null or empty vector or null or non-finite
    components take no part; without ``keep_zero`` zero vectors neither."""
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    d = df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter("vec_id is not null and size(vec) > 0")
    d = d.filter(F.forall("vec", ok))
    if not keep_zero:
        d = d.filter(F.exists("vec", lambda x: x != 0))
    d = d.select("vec_id", F.transform("vec", lambda x: value(x).cast(kind)).alias("vec"))
    return d.groupBy("vec_id", "vec").agg(F.count(F.lit(1)).alias("copies"))


def spread(n: int | Column) -> Column:
    """A part of 0..n-1 for each row, by a hash of the whole row's content."""
    return F.pmod(F.xxhash64("vec_id", "vec"), F.lit(n) if isinstance(n, int) else n).cast("int")


def over(n: int | Column) -> Column:
    """One row for each part of the other side."""
    return F.explode(F.sequence(F.lit(0), (F.lit(n) if isinstance(n, int) else n) - 1))


def matrix(t: pa.Table, dtype) -> np.ndarray:
    lists = t.column("vec").combine_chunks()
    flat = np.asarray(lists.flatten(), dtype=dtype)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def best(found: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """Rank 1..k of each query row over the blocks' own best; copies count as rows of their own."""
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int"))))
    w = Window.partitionBy("query_id", "query_key").orderBy(*order, "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
