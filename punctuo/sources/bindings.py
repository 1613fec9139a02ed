"""Bindings: the driver's test tables → the contract views of the operators.

The surveyed application's own input files are not available, so the
TPC-H-like test tables are mapped onto the flight contract (FIXTURES.md §B).
Every view is a lazy DataFrame over the Parquet files, so the operators' filters
and projections still reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuo.functions import columns as X
from punctuo.sources.files import file_order

# --- fixed values of the bindings (FIXTURES.md §B) ---------------------------
# delay = value − 20 (events) or quantity − 20 (line items); home nation 21;
# place coordinates lat = −60 + 5·key, lon = −170 + 14·key; duplicates are the
# rows with event_id < 50 (exact copies) and 50 ≤ event_id < 100 (same
# identifier, other actual time).
DELAY_SHIFT = 20.0
HOME_NATION = 21
NO_KEY_A_NATION = 24
EXACT_COPY_BELOW = 50
KEY_COPY_BELOW = 100
# --- end of fixed values ------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def flights_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event as a clean flight (timestamp down to the hour)."""
    ev = table(spark, sf_dir, "events")
    delay = F.col("value") - F.lit(DELAY_SHIFT)
    cal = X.calendar_columns("ts")
    return ev.select(
        F.col("event_id").alias("flight_id"),
        F.col("ts").alias("planned_ts"),
        cal["day"].alias("day"), cal["year"].alias("year"), cal["month"].alias("month"),
        cal["weekday"].alias("weekday"), cal["hour"].alias("hour"),
        delay.alias("delay_min"),
        X.late_flag(delay).alias("is_late"),
        F.when(F.col("event_id") % 2 == 0, F.lit("departure")).otherwise(F.lit("arrival")).alias("direction"),
        F.col("event_type").alias("aircraft"),
        F.concat(F.lit("A"), (F.col("user_id") % 40).cast("string")).alias("airline"),
        F.concat(F.lit("R"), (F.col("event_id") % 4).cast("string")).alias("runway"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("place_code"),
    )


def flights_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part.

    Catalyst prunes every table to the listed columns; AQE picks broadcast for
    nation and sort-merge/shuffle-hash for the large keys at scale."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, F.col("o_custkey") == c.c_custkey)
         .join(n, F.col("c_nationkey") == n.n_nationkey)
         .join(p, F.col("l_partkey") == p.p_partkey))
    day = F.to_date("o_orderdate")
    delay = F.col("l_quantity") - F.lit(DELAY_SHIFT)
    ok = F.col("o_orderkey")
    place = (F.when(ok % 50 == 0, F.lit(None).cast("string"))
             .when(ok % 49 == 0, F.lit("XXXX"))
             .when(ok % 10 == 1, F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))
             .otherwise(F.col("n_name")))
    return j.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
        day.alias("day"),
        F.year(day).cast("int").alias("year"),
        F.month(day).cast("int").alias("month"),
        F.weekday(day).cast("int").alias("weekday"),
        delay.alias("delay_min"),
        X.late_flag(delay).alias("is_late"),
        X.map_codes("l_returnflag", {"A": "departure", "R": "arrival"}).alias("direction"),
        F.col("p_brand").alias("airline"),
        F.col("p_type").alias("aircraft"),
        place.alias("place_code"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place dimension (airport file stand-in): two lookup keys, coordinates."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        k.cast("int").alias("place_id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("region"),
        F.when(k == NO_KEY_A_NATION, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("key_a"),
        F.concat(F.lit("N"), k.cast("string")).alias("key_b"),
        (F.lit(-60.0) + F.lit(5.0) * k.cast("double")).alias("lat"),
        (F.lit(-170.0) + F.lit(14.0) * k.cast("double")).alias("lon"),
        (k == HOME_NATION).alias("is_home"),
    )


def weather_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day of ``events`` with daily-weather columns."""
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    v = F.col("value")
    daily = ev.groupBy(F.to_date("ts").alias("day")).agg(
        F.max(F.when(et == "error", v)).alias("_gust"),
        (F.avg(F.when(et == "view", v)) - F.lit(33.0)).alias("tavg"),
        F.greatest(F.avg(F.when(et == "click", v)) - F.lit(35.0), F.lit(0.0)).alias("prcp"),
        (F.lit(1000.0) + F.avg(F.when(et == "purchase", v)) - F.lit(30.0)).alias("pres"),
    )
    gust = F.when(F.dayofmonth("day") % 10 == 0, F.lit(None).cast("double")).otherwise(F.col("_gust"))
    return daily.select(
        "day",
        F.col("tavg"),
        (F.col("tavg") - F.lit(5.0)).alias("tmin"),
        F.col("prcp"),
        (gust / F.lit(3.5)).alias("wspd"),
        gust.alias("wpgt"),
        F.col("pres"),
    )


def raw_ev_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_ev`` with the column ``_order``, a row's place in the file."""
    ev = table(spark, sf_dir, "events").withColumn("_order", file_order())
    return _raw_select(ev, F.lit(0), F.col("_order"))


def raw_ev(spark: SparkSession, sf_dir: str, duplicates: bool = False) -> DataFrame:
    """The raw all-string flight file, derived from ``events``.

    The actual time keeps only its clock time, so rows whose actual time passes
    midnight need the rollover repair. With ``duplicates`` the rows with
    ``event_id < 50`` are appended again (exact copies) and the rows with
    ``50 <= event_id < 100`` again with the actual time one minute later."""
    ev = table(spark, sf_dir, "events")
    raw = _raw_select(ev, F.lit(0))
    if not duplicates:
        return raw
    exact = _raw_select(ev.filter(F.col("event_id") < EXACT_COPY_BELOW), F.lit(0))
    near = _raw_select(ev.filter((F.col("event_id") >= EXACT_COPY_BELOW) & (F.col("event_id") < KEY_COPY_BELOW)), F.lit(60))
    return raw.unionByName(exact).unionByName(near)


def _raw_select(ev: DataFrame, extra_seconds, *also) -> DataFrame:
    eid, uid = F.col("event_id"), F.col("user_id")
    actual = F.timestamp_add("SECOND", (F.floor(F.col("value") * 60) + extra_seconds).cast("long"), F.col("ts"))
    place = F.concat(F.lit("NATION_"), (uid % 25).cast("string"))
    return ev.select(
        eid.cast("string").alias("Identifier"),
        F.date_format("ts", "dd/MM/yyyy").alias("STD"),
        F.date_format("ts", "HH:mm:ss").alias("STA_STD_ltc"),
        F.date_format(actual, "HH:mm:ss").alias("ATA_ATD_ltc"),
        F.concat(F.lit(" "), F.when(eid % 3 == 0, F.lit("EZY")).otherwise(F.lit("LX")), uid.cast("string"), F.lit(" ")).alias("FLT"),
        (F.when(eid % 5 == 0, F.lit("X")).when(eid % 5 == 1, F.lit("S")).when(eid % 5 == 2, F.lit("L"))
         .when(eid % 5 == 3, F.lit("S")).otherwise(F.lit("L"))).alias("LSV"),
        F.when(eid % 7 == 0, F.lit("-")).otherwise(F.concat(F.lit("G"), (eid % 30).cast("string"))).alias("GAT"),
        F.col("event_type").alias("ACT"),
        F.when(eid % 11 == 0, F.lit("#N/A")).otherwise(place).alias("Org/Des"),
        *also,
    )


def scored_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``flights_ev`` with a fixed, deterministic score (for evaluation queries)."""
    f = flights_ev(spark, sf_dir)
    p = F.round((F.col("hour") * 4 + F.col("weekday") * 3 + F.col("flight_id") % 17) / F.lit(140.0), 4)
    return f.withColumn("p_late", p).withColumn("pred_min", F.col("hour").cast("double") - F.lit(5.0))
