"""The model's rows lie in partitions of bounded size, however the file is cut."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from punctuo.operators import util
from punctuo.plans import queries as Q


def sizes(df):
    return [r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_sides_of_the_model_table_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    rows = [{"event_id": i, "ts": dt.datetime(2024, 1, 1 + i % 5, i % 24, i % 60), "user_id": i % 90, "value": float(i % 50), "event_type": "view"} for i in range(3000)]
    pq.write_table(pa.Table.from_pylist(rows), tmp_path / "events.parquet")  # one row group
    for t in ("nation", "region"):
        (tmp_path / f"{t}.parquet").symlink_to(f"/root/testdata/sf0.001/{t}.parquet")
    monkeypatch.setattr(util, "DEALT_ROWS", 300)
    train, test = Q._split_model_table(spark, str(tmp_path))
    assert max(sizes(train)) < 600 and max(sizes(test)) < 600
    assert sorted(r.flight_id for r in train.union(test).select("flight_id").collect()) == list(range(3000))
    train.unpersist(), test.unpersist()


def test_small_tables_stay_and_null_keys_spread(spark):
    small = spark.range(50).coalesce(1)
    assert util.deal_rows(small, ["id"], 50) is small
    t = spark.range(1000).select(F.lit(None).cast("long").alias("k"), F.col("id").cast("double").alias("v")).coalesce(1)
    dealt = util.deal_rows(t, ["k", "v"], 100)
    assert dealt.rdd.getNumPartitions() == 10 and max(sizes(dealt)) < 200 and dealt.distinct().count() == 1000
