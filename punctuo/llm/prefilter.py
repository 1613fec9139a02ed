"""A bitmap of keys that drops most rows without a partner before they are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 64 bits each: 65,536 rows of two numbers at most, whatever the number of keys.
SLOTS = 1 << 16


def likely(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is among ``keys``, and a few others (more as the bitmap fills); a join must follow."""
    slot = f"pmod(xxhash64({key}), {SLOTS})"
    bit = f"shiftleft(1L, cast(pmod(shiftright(xxhash64({key}), 20), 64) as int))"
    masks = keys.select(F.expr(slot).alias("key_slot"), F.expr(bit).alias("key_bit")).groupBy("key_slot").agg(F.bit_or("key_bit").alias("key_mask"))
    kept = rows.withColumn("key_slot", F.expr(slot)).join(F.broadcast(masks), "key_slot")
    return kept.filter(F.col("key_mask").bitwiseAND(F.expr(bit)) != 0).select(*rows.columns)
