"""Cleaning of the raw all-string flight table.

Plan shape: trim + sentinel → exact-duplicate removal as one hash aggregation
(map-side combine keeps a hot duplicated row cheap) → narrow projections that
whole-stage codegen fuses. The duplicate counter rides along as ``_copies`` so
the metrics need no second scan of the raw input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from punctuo import config as C
from punctuo.config import DEFAULTS, Params
from punctuo.functions import columns as X

# Raw columns the derivation consumes (fixed by the file format).
RAW_DATE, RAW_PLANNED, RAW_ACTUAL, RAW_ID = "STD", "STA_STD_ltc", "ATA_ATD_ltc", "Identifier"
RAW_FLIGHT, RAW_DIRECTION = "FLT", "LSV"
# Renames of source columns to the clean contract.
DEFAULT_RENAMES = {"FLT": "flight_no", "ACT": "aircraft", "RWY": "runway", "Org/Des": "place_code"}
DROPPED = (RAW_DATE, RAW_PLANNED, RAW_ACTUAL)
# Working columns of the counters.
COUNTED = ("_raw_delay", "_copies")


def q(name: str):
    return F.col(f"`{name}`")


def prepare_raw(raw: DataFrame, tokens=C.FLIGHT_NULL_TOKENS) -> DataFrame:
    """C1 + C2: trim every string column, missing markers → NULL."""
    return X.null_tokens(X.trim_strings(raw), tokens)


def with_copies(df: DataFrame) -> DataFrame:
    """C4: one row per distinct row, with ``_copies`` = how often it occurred."""
    return df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))


def derive_times(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """C5–C9 + C10 + C11 + C14 on a prepared table (keeps every input column)."""
    planned = X.day_time(RAW_DATE, RAW_PLANNED)
    actual0 = X.day_time(RAW_DATE, RAW_ACTUAL)
    out = df.withColumns({"_day": X.parse_day(RAW_DATE), "planned_ts": planned, "_actual0": actual0})
    step = {"_raw_delay": X.minutes_between("planned_ts", "_actual0"),
            "rolled_over": X.rollover_flag("planned_ts", "_actual0", params.rollover_min)}
    if params.symmetric_rollover:
        step["rolled_back"] = X.early_rollover_flag("planned_ts", "_actual0", params.rollover_min)
    out = out.withColumns(step)
    actual = F.when(F.col("rolled_over"), X.add_days("_actual0", 1))
    if params.symmetric_rollover:
        actual = actual.when(F.col("rolled_back"), X.add_days("_actual0", -1))
    out = out.withColumn("actual_ts", actual.otherwise(F.col("_actual0")))
    out = out.withColumn("delay_min", X.minutes_between("planned_ts", "actual_ts"))
    cal = X.calendar_columns("planned_ts", day="_day")
    return out.withColumns({
        "is_late": X.late_flag("delay_min", params.late_min),
        "day": cal["day"], "year": cal["year"], "month": cal["month"], "weekday": cal["weekday"], "hour": cal["hour"],
        "direction": X.map_codes(RAW_DIRECTION, C.DIRECTION_CODES),
        "airline": X.airline_prefix(RAW_FLIGHT),
    })


def clean_flights(raw: DataFrame, params: Params = DEFAULTS, renames: dict | None = None,
                  drop_identifier: bool = False, counted: bool = False) -> DataFrame:
    """The clean fact from the raw string table (without place/weather/load columns).

    ``counted``: the columns that ``observed`` reads and drops stay."""
    renames = DEFAULT_RENAMES if renames is None else renames
    d = derive_times(with_copies(prepare_raw(raw)), params)
    drop = set(DROPPED) | {"_day", "_actual0"} | (set() if counted else set(COUNTED))
    if drop_identifier:
        drop.add(RAW_ID)
    keep = [c for c in d.columns if c not in drop]
    return d.select(*[q(c).alias(renames.get(c, c)) for c in keep])


def clean_metrics(raw: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """A20 + A21: one-row cleaning report computed in a single aggregation.

    duplicate_ids counts rows whose identifier occurred before (a NULL
    identifier repeats like any other value, as in ``duplicated()``)."""
    d = derive_times(with_copies(prepare_raw(raw)), params)
    ident = q(RAW_ID)
    return d.agg(
        F.sum("_copies").alias("raw_rows"),
        F.lit(len(raw.columns)).alias("raw_cols"),
        (F.sum("_copies") - F.count(F.lit(1))).alias("duplicate_rows"),
        (F.count(F.lit(1)) - F.count_distinct(ident)
         - F.max(ident.isNull().cast("int"))).alias("duplicate_ids"),
        F.count_if("rolled_over").alias("rollovers"),
        F.min("_raw_delay").alias("min_before"),
        F.min("delay_min").alias("min_after"),
        F.max("delay_min").alias("max_after"),
    )


def observed(fact: DataFrame, counters: Observation) -> DataFrame:
    """A20 + S8: the counters of a build, collected by whatever action runs on the result.

    ``fact``: ``clean_flights(counted=True)``, with ``matched_by`` if places are looked up.
    Put it last, right before the write: there every row passes in the one final stage, so a
    lost executor's rows are counted by their second run alone."""
    aggs = [F.sum("_copies").alias("raw_rows"), F.count(F.lit(1)).alias("rows"), F.count_if("rolled_over").alias("rollovers"),
            F.min("_raw_delay").alias("min_before"), F.min("delay_min").alias("min_after"), F.max("delay_min").alias("max_after"),
            F.sum("delay_min").alias("sum_delay"), F.count("delay_min").alias("n_delay")]
    if "matched_by" in fact.columns:
        m = F.col("matched_by")
        aggs += [F.count_if(m == "key_a").alias("via_key_a"), F.count_if(m == "key_b").alias("via_key_b"),
                 F.count_if(F.col("place_code").isNull()).alias("without_code"), F.count_if(F.col("place_code").isNotNull() & m.isNull()).alias("code_unknown")]
    return fact.observe(counters, *aggs).drop(*COUNTED)


def rolled_rows(clean: DataFrame) -> DataFrame:
    """P10 + C28: corrected rows with the uncorrected delay for comparison."""
    return clean.filter("rolled_over").select(
        "flight_no", "planned_ts", "actual_ts", "delay_min",
        (F.col("delay_min") - F.lit(1440.0)).alias("delay_uncorrected"))
