"""A2 per-day time line, maintained incrementally from arriving schedule files.

Event time is the planned departure/arrival; a day is emitted (append mode)
once the watermark passes its end, so late files up to ``lateness`` are still
counted and state for closed days is dropped. Measures are the streaming-safe
ones of the time line: flights, mean delay, % late (per direction and for all
flights, as two aggregations in the same micro-batch plan).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuo.config import DEFAULTS, Params
from punctuo.operators import clean as CL
from punctuo.sources.files import string_schema


def daily_rows(stream: DataFrame, params: Params = DEFAULTS, lateness: str = "2 days") -> DataFrame:
    """Row-local cleaning of a stream (no de-duplication or load features:
    those need the whole day), watermarked on the planned time.

    Watermarks need a zoned TIMESTAMP: the local clock time is read in the
    session time zone (UTC keeps day windows on calendar days)."""
    d = CL.derive_times(CL.prepare_raw(stream), params)
    return (d.select(F.col("planned_ts").cast("timestamp").alias("event_ts"), "direction", "delay_min", "is_late")
             .withWatermark("event_ts", lateness))


def daily_timeline(rows: DataFrame) -> DataFrame:
    """Per (day window, direction): n, mean delay, % late — one streaming aggregation."""
    w = F.window("event_ts", "1 day")
    return rows.groupBy(w.alias("w"), F.coalesce(F.col("direction"), F.lit("unknown")).alias("series")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("delay_min").alias("avg_delay"),
        (F.avg(F.col("is_late").cast("double")) * 100).alias("late_pct"),
    ).select(F.to_date(F.col("w.start")).alias("bucket"), "series", "n", "avg_delay", "late_pct")


def start_daily_timeline(spark: SparkSession, source_dir: str, columns: Sequence[str], out_path: str,
                         checkpoint: str, params: Params = DEFAULTS, lateness: str = "2 days",
                         available_now: bool = True):
    """Start the stream (append mode to Parquet); returns the ``StreamingQuery``."""
    stream = spark.readStream.schema(string_schema(columns)).option("header", True).option("enforceSchema", False).csv(source_dir)
    out = daily_timeline(daily_rows(stream, params, lateness))
    writer = (out.writeStream.outputMode("append").format("parquet").option("path", out_path)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
