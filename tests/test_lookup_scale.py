"""The lookup beyond the broadcast bound, and examples in file order."""

from pyspark.sql import functions as F

from punctuo.config import DEFAULTS
from punctuo.operators import lookup as LK
from punctuo.operators import profile as PR
from punctuo.sources.files import file_order


def hot_fact(spark, rows=80_000, places=5000):
    """Half of the rows without a code, a quarter with one code, the rest over many (some unknown)."""
    i = F.col("id")
    code = F.when(i % 2 == 0, F.lit(None).cast("string")).when(i % 4 == 1, F.lit("P7")).otherwise(F.concat(F.lit("P"), (i % (places + 50)).cast("string")))
    fact = spark.range(rows, numPartitions=8).select(i.alias("flight_id"), code.alias("place_code"), F.lit("x").alias("_tag"))
    k = F.col("id")
    dim = spark.range(places).select(k.alias("place_id"), F.when(k % 3 == 0, None).otherwise(F.concat(F.lit("P"), k.cast("string"))).alias("key_a"),
                                     F.concat(F.lit("P"), k.cast("string")).alias("key_b"), F.concat(F.lit("name "), k.cast("string")).alias("name"))
    return fact, dim


def test_salted_lookup_equals_broadcast_and_is_even(spark):
    fact, dim = hot_fact(spark)
    args = (fact, dim, "place_code", "key_a", "key_b", ["name"], ["place_id"], "name")
    want = LK.lookup_two_keys(*args)
    adaptive, wide = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = LK.lookup_two_keys(*args, DEFAULTS.with_(broadcast_max_rows=10))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        parts = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
        assert sum(parts) == 80_000 and parts[-1] <= 2 * parts[len(parts) // 2], parts
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", wide)


def test_salted_join_of_few_rows(spark):
    fact = spark.createDataFrame([("A", 1), (None, 2), ("B", 3), ("A", 1)], "c string, n int")
    dim = spark.createDataFrame([("A", 10), ("C", 30)], "k string, v int")
    assert sorted(LK.salted_left_join(fact, dim, "c", "k").collect(), key=str) == sorted(fact.join(dim, fact.c == dim.k, "left").collect(), key=str)
    assert LK.salted_left_join(fact.limit(0), dim, "c", "k").count() == 0


def test_example_is_the_first_row_in_file_order(spark, tmp_path):
    for name, first in (("b.csv", 500), ("a.csv", 1000)):
        lines = ["x,y"] + [f"{first - i},{'' if i == 0 else i}" for i in range(400)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = spark.read.option("header", True).csv(str(tmp_path)).withColumn("_order", file_order())
        assert df.rdd.getNumPartitions() > 4
        got = {r.column_name: (r.example, r.n_distinct) for r in PR.column_profile(df, order="_order").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {"x": ("1000", 800), "y": (None, 399)}
    assert {r.column_name: r.example for r in PR.column_profile(df.drop("_order")).collect()} == {"x": "1000", "y": "1"}
