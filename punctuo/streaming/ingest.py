"""Incremental ingest: new flight CSV files → cleaned, enriched rows appended
to the partitioned Parquet fact.

The surveyed application reads bounded files only; this is the same E1 path
run per micro-batch so a folder that receives daily schedule files keeps the
fact table current. With ``lateness`` set, exact duplicates are also removed
ACROSS micro-batches (``dropDuplicatesWithinWatermark`` on the prepared raw
columns, state bounded by a watermark on the planned time). Each micro-batch
then goes through the batch operators in ``foreachBatch`` (exact
de-duplication inside the batch, broadcast place and weather lookups) and is
appended by year. Every batch is written under
its own ``batch_id`` folder, so a batch that is retried replaces its first try.
Progress (which files were read) lives in the checkpoint location. Hour and day load and the previous-hour delay
depend on whole days and are derived from the written table, not per batch.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuo.config import DEFAULTS, Params
from punctuo.functions import columns as X
from punctuo.operators import clean as CL
from punctuo.operators import lookup as LK
from punctuo.sources.files import string_schema


def start_ingest(spark: SparkSession, source_dir: str, columns: Sequence[str], places: DataFrame,
                 out_path: str, checkpoint: str, daily: DataFrame | None = None, params: Params = DEFAULTS,
                 place_attrs: Sequence[str] = ("name", "lat", "lon", "distance_km", "area"),
                 key_a: str = "key_a", key_b: str = "key_b", order: Sequence = ("place_id",), found: str = "name",
                 available_now: bool = True, max_files_per_trigger: int = 100, lateness: str | None = None):
    """Start the stream; returns the ``StreamingQuery``.

    ``checkpoint`` must be a shared, durable folder (e.g. under the cluster's
    ``spark.checkpoint.dir``)."""
    stream = (spark.readStream.schema(string_schema(columns)).option("header", True).option("enforceSchema", False)
              .option("maxFilesPerTrigger", max_files_per_trigger).csv(source_dir))
    if lateness:
        prepared = CL.prepare_raw(stream)
        event = X.day_time(CL.RAW_DATE, CL.RAW_PLANNED).cast("timestamp")
        stream = (prepared.withColumn("_event_ts", event).withWatermark("_event_ts", lateness)
                  .dropDuplicatesWithinWatermark(list(columns)).drop("_event_ts"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        c = CL.clean_flights(batch, params)
        c = LK.lookup_two_keys(c, places, "place_code", key_a, key_b, place_attrs, list(order), found, params)
        c = c.drop("_code_in_a", "_code_in_b")
        if daily is not None:
            c = LK.attach_daily(c, daily, params=params)
        # a batch that is retried replaces what its first try has written
        c.write.mode("overwrite").partitionBy("year").parquet(f"{out_path}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
