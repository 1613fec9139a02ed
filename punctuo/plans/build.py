"""E1 — build the clean, enriched fact table.

raw strings → clean (one de-duplicating aggregation) → place lookup and daily
conditions (broadcast joins, no fact shuffle) → written once (Parquet sink, or
Parquet in the shared checkpoint folder) → load / previous-hour
features from the written table (pre-aggregated, broadcast back).
Writing once means the de-duplication shuffle is not recomputed for the
hourly aggregate, and lineage for later reports starts at the written files.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from punctuo.config import DEFAULTS, Params
from punctuo.operators import clean as CL
from punctuo.operators import features as FE
from punctuo.operators import lookup as LK
from punctuo.operators.util import checkpoint_table
from punctuo.sources.files import write_fact


def build_fact(raw: DataFrame, places: DataFrame, daily: DataFrame | None = None, params: Params = DEFAULTS,
               place_attrs: Sequence[str] = ("name", "region", "lat", "lon", "distance_km", "area"),
               key_a: str = "key_a", key_b: str = "key_b", place_order: Sequence = ("place_id",),
               found: str = "name", path: str | None = None, partition_by: Sequence[str] = ("year",),
               counters: Observation | None = None) -> DataFrame:
    """The clean fact with place, weather and load features.

    ``path``: write the pre-feature table there (partitioned by year) and read
    it back; otherwise it is written as Parquet in the shared checkpoint folder.
    ``counters``: filled while the table is written (see ``build_with_report``)."""
    c = CL.clean_flights(raw, params, counted=counters is not None)
    c = LK.lookup_two_keys(c, places, "place_code", key_a, key_b, place_attrs, list(place_order), found, params)
    c = c.drop("_code_in_a", "_code_in_b")
    if daily is not None:
        c = LK.attach_daily(c, daily, params=params)
    if counters is not None:
        c = CL.observed(c, counters)
    if path:
        write_fact(c, path, partition_by)
        c = raw.sparkSession.read.parquet(path)
    else:
        c = checkpoint_table(c)
    return FE.add_load_features(c, params)


REPORT = ("raw_rows long, rows long, duplicate_rows long, rollovers long, min_before double, min_after double, max_after double, "
          "avg_delay double, via_key_a long, via_key_b long, without_code long, code_unknown long")


def build_with_report(raw: DataFrame, places: DataFrame, daily: DataFrame | None = None, params: Params = DEFAULTS, **kw) -> tuple[DataFrame, DataFrame]:
    """``build_fact`` and its one-row report (S8, A20, A22's row counts): the counters are
    collected by the write itself, so building and reporting read the raw rows once.

    The number of repeated identifiers isn't in it: a distinct count needs a shuffle by
    identifier (``clean.clean_metrics``). An empty table has counts of 0 and NULL delays."""
    counters = Observation("build")
    fact = build_fact(raw, places, daily, params, counters=counters, **kw)
    return fact, report_of(raw.sparkSession, counters)


def report_of(spark: SparkSession, counters: Observation) -> DataFrame:
    """The report of a build whose write has run (waits for it otherwise)."""
    got = dict(counters.get)
    got["raw_rows"] = got["raw_rows"] or 0
    got["duplicate_rows"] = got["raw_rows"] - got["rows"]
    got["avg_delay"] = got["sum_delay"] / got["n_delay"] if got["n_delay"] else None
    names = [part.split()[0] for part in REPORT.split(", ")]
    return spark.createDataFrame([tuple(got[n] for n in names)], REPORT)


def airport_dimension(airports: DataFrame, home_code: str, params: Params = DEFAULTS) -> DataFrame:
    """Airports with distance from the home airport (ICAO ``home_code``) and area.

    File order is represented by the numeric ``Airport_ID`` (first row wins)."""
    from pyspark.sql import functions as F
    dim = airports.withColumn("_order", F.col("Airport_ID").try_cast("int"))
    return LK.with_distance(dim, F.col("ICAO") == home_code, "_order", "Latitude", "Longitude", params)


def build_from_files(spark, flights_path: str, airports_path: str, weather_path: str, params: Params = DEFAULTS,
                     home_code: str | None = None, bad_rain_from: str | None = None,
                     path: str | None = None, counters: Observation | None = None) -> DataFrame:
    """S1–S6 + E1: the three source files to the enriched fact (optionally written, with ``counters`` filled)."""
    from punctuo import config as C
    from punctuo.sources import files as S
    raw = S.read_flights(spark, flights_path)
    dim = airport_dimension(S.read_airports(spark, airports_path), home_code or C.HOME_CODE, params)
    daily = S.clean_weather(S.read_weather(spark, weather_path), bad_rain_from or C.BAD_RAIN_FROM)
    attrs = ("Name", "City", "Country", "IATA", "ICAO", "Latitude", "Longitude", "distance_km", "area")
    return build_fact(raw, dim, daily, params, place_attrs=attrs, key_a="ICAO", key_b="IATA",
                      place_order=("_order",), found="Name", path=path, counters=counters)
