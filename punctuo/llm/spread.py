"""Inner joins whose hot keys are dealt over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of all rows on (so at most ``SHARE`` keys are, whatever the data), and from ``ROWS`` rows on.
SHARE, ROWS, SALTS = 1024, 4096, 64


def join_hot(rows: DataFrame, one: DataFrame, keys: list[str], own: list[str]) -> DataFrame:
    """``rows`` join ``one`` (one row per ``keys``): the rows of a hot key are dealt over ``SALTS`` salts by the hash of
    ``own``, its row of ``one`` is repeated for each; the table of hot keys has at most ``SHARE`` rows and is broadcast."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("hot_n")).filter(F.col("hot_n") >= ROWS)
    total = rows.select(F.count(F.lit(1))).scalar()
    hot = F.broadcast(counts.filter(F.col("hot_n") * SHARE >= total).select(*keys, F.lit(True).alias("hot_key")))
    salt = F.when(F.col("hot_key"), F.pmod(F.xxhash64(*own), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    salts = F.when(F.col("hot_key"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.join(hot, keys, "left").withColumn("hot_salt", salt).drop("hot_key")
    copies = one.join(hot, keys, "left").withColumn("hot_salt", F.explode(salts)).drop("hot_key")
    return dealt.join(copies, [*keys, "hot_salt"]).drop("hot_salt")
