"""Named queries: each is ``(spark, sf_dir) -> DataFrame`` over the bindings.

Parameters that depend on data volume (minimum support, bin edges, years) are
set for the driver's test tables (FIXTURES.md); the operator defaults keep the
surveyed application's values. Doubles are rounded to 6 decimals at this
(presentation) layer only, so the oracle comparison is not decided by the last
bit of a floating-point sum.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuo import config as C
from punctuo.config import DEFAULTS
from punctuo.functions import columns as X
from punctuo.operators import clean as CL
from punctuo.operators import evaluate as EV
from punctuo.operators import features as FE
from punctuo.operators import lookup as LK
from punctuo.operators import profile as PR
from punctuo.operators import reports as RP
from punctuo.operators.util import checkpoint_table, deal_rows, materialize, persist_table, sized_broadcast
from punctuo.sources import bindings as B

# --- parameters of the test-table bindings (FIXTURES.md §B) -----------------
YEAR_A, YEAR_B = 1999, 2000
LOAD_EDGES_EV = (0, 10, 12, 14, 16, 20, 100, 120, 140, 160, 1_000_000_000)
GUST_EDGES_EV = (0, 150, 200, 250, 300, 350, 400, 1_000_000_000)
# busy and quiet hours, stormy and calm days: so much of the mean hour load and of the mean daily gust
BUSY_SHARE, QUIET_SHARE = 1.1, 0.9
STORM_SHARE, CALM_SHARE = 1.1, 0.9
BAD_RAIN_FROM_EV = "2024-01-21"
PLACE_MONTHS = ("1995-01-01", "2001-08-01")
PERIODS = {"jul-sep": (7, 8, 9), "dec": (12,), "from-apr": tuple(range(4, 13))}
PLACE_ATTRS = ("place_id", "name", "region", "lat", "lon", "distance_km", "area")
# ----------------------------------------------------------------------------

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


# ------------------------------------------------------------------ shared views
def clean_ev(spark, sf_dir, duplicates: bool = False) -> DataFrame:
    return CL.clean_flights(B.raw_ev(spark, sf_dir, duplicates))


def places_geo(spark, sf_dir) -> DataFrame:
    """Place dimension with distance from home and area (computed per place)."""
    return LK.with_distance(B.places(spark, sf_dir), F.col("is_home"), "place_id")


def enriched_or(spark, sf_dir) -> DataFrame:
    """flights_or + two-key place lookup."""
    return LK.lookup_two_keys(B.flights_or(spark, sf_dir), places_geo(spark, sf_dir), "place_code",
                              "key_a", "key_b", PLACE_ATTRS, ["place_id"], "name").drop("_code_in_a", "_code_in_b")


def weathered_ev(spark, sf_dir) -> DataFrame:
    """flights_ev + hour load + daily weather."""
    f = FE.add_load_features(B.flights_ev(spark, sf_dir), which=("hour_load",))
    return LK.attach_daily(f, B.weather_ev(spark, sf_dir))


def test_scored(spark, sf_dir) -> DataFrame:
    s = B.scored_ev(spark, sf_dir)
    return EV.with_split(s, EV.day_split(s)).filter("is_test")


# ------------------------------------------------------------------ cleaning
@query
def clean_rollover(spark, sf_dir):
    return rounded(CL.rolled_rows(clean_ev(spark, sf_dir)))


@query
def clean_metrics(spark, sf_dir):
    return rounded(CL.clean_metrics(B.raw_ev(spark, sf_dir, duplicates=True)))


@query
def duplicate_keys(spark, sf_dir):
    """A21 detail: identifiers that occur more than once after exact de-duplication."""
    c = clean_ev(spark, sf_dir, duplicates=True)
    return c.groupBy("Identifier").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


@query
def calendar_and_prefix(spark, sf_dir):
    c = clean_ev(spark, sf_dir)
    return c.select(F.col("Identifier").alias("flight_key"), "day", "year", "month", "weekday",
                    X.ordinal_name("weekday", C.WEEKDAY_NAMES, base=0).alias("weekday_name"),
                    X.ordinal_name("month", C.MONTH_NAMES, base=1).alias("month_name"),
                    "hour", "direction", "airline", "flight_no")


@query
def fact_table(spark, sf_dir):
    """E1 end to end: raw strings → clean → place lookup → weather → load features."""
    from punctuo.plans.build import build_fact
    c = build_fact(B.raw_ev(spark, sf_dir), places_geo(spark, sf_dir), B.weather_ev(spark, sf_dir))
    return rounded(c.drop("planned_ts", "actual_ts"))


@query
def raw_preview(spark, sf_dir):
    """The first 8 raw rows (explicit order: identifier as a number)."""
    from punctuo.sources.files import preview
    r = B.raw_ev(spark, sf_dir)
    return preview(r.withColumn("_k", F.col("Identifier").cast("long")), ["_k"], 8).drop("_k")


@query
def build_summary(spark, sf_dir):
    """One-row summary of a build: rows, rollovers, matches, mean delay."""
    c = LK.lookup_two_keys(clean_ev(spark, sf_dir), places_geo(spark, sf_dir), "place_code", "key_a", "key_b",
                           ("name",), ["place_id"], "name")
    m = F.col("matched_by")
    return rounded(c.agg(F.count(F.lit(1)).alias("rows"), F.count_if("rolled_over").alias("rollovers"),
                         F.count_if(m == "key_a").alias("via_key_a"), F.count_if(m == "key_b").alias("via_key_b"),
                         F.count_if(F.col("place_code").isNotNull() & m.isNull()).alias("code_unknown"),
                         F.avg("delay_min").alias("avg_delay")))


@query
def build_report(spark, sf_dir):
    """E1 + S8 + A20: the counters that the build collects while it writes the fact."""
    from punctuo.plans.build import build_with_report
    return rounded(build_with_report(B.raw_ev(spark, sf_dir, duplicates=True), places_geo(spark, sf_dir), B.weather_ev(spark, sf_dir))[1])


@query
def direction_code_freq(spark, sf_dir):
    """C12 + A17: direction codes labelled, unknown codes keep their own value."""
    r = CL.prepare_raw(B.raw_ev(spark, sf_dir))
    lab = X.map_codes("LSV", C.DIRECTION_CODES, default=F.col("LSV"))
    return PR.value_freq(r.select(lab.alias("direction_label")), "direction_label")


# ------------------------------------------------------------------ files
def written_csv(df: DataFrame, **options) -> str:
    """``df`` as CSV files in the shared folder, for the readers."""
    from punctuo.operators.util import shared_path

    path = shared_path(df.sparkSession)
    df.write.options(**options).csv(path)
    return path


@query
def csv_clean_roundtrip(spark, sf_dir):
    """S1 → C1–C14 → S6: the raw strings as header CSV files of two column orders, read by name, cleaned, written by year and read back."""
    from punctuo.operators.util import shared_path
    from punctuo.sources import files as SF

    raw = B.raw_ev(spark, sf_dir, duplicates=True)
    path, names, even = shared_path(spark), raw.columns, F.pmod(F.xxhash64("Identifier"), F.lit(2)) == 0
    raw.filter(even).write.option("header", True).csv(path)
    raw.filter(~even).select(*reversed(names)).write.mode("append").option("header", True).csv(path)
    clean = CL.clean_flights(SF.read_flights(spark, path, names, headers="each"))
    out = shared_path(spark)
    SF.write_fact(clean, out)
    c = spark.read.parquet(out)
    return rounded(c.select("Identifier", "flight_no", "direction", "airline", "place_code", "planned_ts", "actual_ts", "rolled_over", "delay_min", "is_late", "day",
                            *[F.col(x).cast("int").alias(x) for x in ("year", "month", "weekday", "hour")]))


@query
def airports_read(spark, sf_dir):
    """S3 + C1–C3: a headerless file of 14 columns with quotes, missing marks, blanks and numbers that are none."""
    from punctuo.sources import files as SF

    p = B.places(spark, sf_dir)
    text = lambda c: F.coalesce(c.cast("string"), F.lit("\\N"))
    none = F.lit("\\N")
    cols = [text(F.col("place_id")), F.concat(F.lit('  The "'), F.col("name"), F.lit('", Airport ')), text(F.col("name")), text(F.col("region")), text(F.col("key_b")), text(F.col("key_a")),
            F.when(F.col("place_id") % 5 == 0, "north").otherwise(text(F.col("lat"))), text(F.col("lon")), F.lit(" 12 "), F.lit(""), F.lit("E"), none, F.lit("airport"), F.lit("x")]
    path = written_csv(p.select(*[c.alias(n) for c, n in zip(cols, SF.AIRPORT_COLUMNS, strict=True)]), escape='"', quoteAll=True)
    return rounded(SF.read_airports(spark, path))


@query
def weather_read(spark, sf_dir):
    """S4, S5 + C15: daily weather files of two column orders, one with a column more, read by name and cleaned."""
    from punctuo.operators.util import shared_path
    from punctuo.sources import files as SF

    names = [f.name for f in SF.WEATHER_SCHEMA.fields]
    w = B.weather_ev(spark, sf_dir)
    raw = w.select(*[(F.col("day") if n == "date" else F.col(n) if n in w.columns else F.lit(None)).cast("string").alias(n) for n in names], F.lit("EDDF").alias("station"))
    path, early = shared_path(spark), F.dayofmonth("date") <= 15
    raw.filter(early).write.option("header", True).csv(path)
    raw.filter(~early).select("station", *reversed(names)).write.mode("append").option("header", True).csv(path)
    return rounded(SF.clean_weather(SF.read_weather(spark, path, headers="each"), BAD_RAIN_FROM_EV))


# ------------------------------------------------------------------ weather source checks
@query
def bad_period_check(spark, sf_dir):
    return rounded(PR.suspect_period(B.weather_ev(spark, sf_dir), "prcp", BAD_RAIN_FROM_EV))


@query
def raw_rain_series(spark, sf_dir):
    """The untouched daily precipitation series (before the suspect period is nulled)."""
    return rounded(B.weather_ev(spark, sf_dir).select("day", "prcp"))


@query
def bad_period_null(spark, sf_dir):
    return rounded(PR.null_suspect(B.weather_ev(spark, sf_dir), "prcp", BAD_RAIN_FROM_EV))


# ------------------------------------------------------------------ time and load reports
@query
def summary_direction_hour(spark, sf_dir):
    return rounded(RP.summary(B.flights_ev(spark, sf_dir), ["direction", "hour"], min_n=100))


@query
def summary_load_class(spark, sf_dir):
    f = FE.add_load_features(B.flights_ev(spark, sf_dir), which=("hour_load",))
    f = f.withColumn("load_bin", X.bin_number("hour_load", LOAD_EDGES_EV, "right"))
    s = RP.summary(f, ["direction", "load_bin"], min_n=200)
    return rounded(s.withColumn("load_class", X.ordinal_name("load_bin", X.edge_labels(LOAD_EDGES_EV, "right"), base=1)))


@query
def load_class_ends(spark, sf_dir):
    """First and last load class (with enough flights) and their % late."""
    f = FE.add_load_features(B.flights_ev(spark, sf_dir), which=("hour_load",))
    s = RP.summary(f.withColumn("load_bin", X.bin_number("hour_load", LOAD_EDGES_EV, "right")), "load_bin", min_n=200)
    return rounded(s.agg(F.min("load_bin").alias("first_bin"), F.min_by("late_pct", "load_bin").alias("first_late_pct"),
                         F.max("load_bin").alias("last_bin"), F.max_by("late_pct", "load_bin").alias("last_late_pct")))


@query
def heat_weekday_hour(spark, sf_dir):
    return rounded(RP.heat_grid(B.flights_ev(spark, sf_dir), min_n=30))


@query
def compare_groups(spark, sf_dir):
    return rounded(RP.top_groups(B.flights_or(spark, sf_dir), "airline", min_n=100, top=12))


@query
def timeline_day_rolling(spark, sf_dir):
    return rounded(RP.timeline(B.flights_ev(spark, sf_dir), "day", "direction", rolling=7, min_periods=4))


@query
def timeline_week(spark, sf_dir):
    return rounded(RP.timeline(B.flights_ev(spark, sf_dir), "week", "direction"))


@query
def timeline_month(spark, sf_dir):
    return rounded(RP.timeline(B.flights_or(spark, sf_dir), "month", "direction"))


@query
def arg_extremes(spark, sf_dir):
    f = B.flights_ev(spark, sf_dir)
    by_hour = RP.summary(f, ["direction", "hour"], min_n=100)
    by_wd = RP.summary(f, "weekday")
    out = RP.arg_extremes(by_hour, "late_pct", ["direction", "hour"], "hour")
    out = out.unionByName(RP.arg_extremes(by_wd, "late_pct", ["weekday"], "weekday"))
    return rounded(out)


# ------------------------------------------------------------------ headline and years
@query
def headline(spark, sf_dir):
    return rounded(RP.headline(B.flights_or(spark, sf_dir)))


@query
def headline_delta(spark, sf_dir):
    return rounded(RP.headline_delta(B.flights_or(spark, sf_dir), YEAR_A, YEAR_B))


@query
def filtered_headline(spark, sf_dir):
    """P1 + P2 + P8: filters, then the headline; empty when under 50 rows."""
    base = RP.apply_filters(B.flights_or(spark, sf_dir), direction="departure",
                            airlines=("Brand#11", "Brand#22", "Brand#33"), year=YEAR_A)
    from punctuo.operators.util import require_rows
    return rounded(require_rows(RP.headline(base), base, 50))


@query
def year_compare(spark, sf_dir):
    return rounded(RP.by_year(B.flights_or(spark, sf_dir)))


@query
def year_delta(spark, sf_dir):
    """A5: the measures of two years side by side with their differences."""
    return rounded(RP.year_delta(B.flights_or(spark, sf_dir), YEAR_A, YEAR_B))


@query
def year_month(spark, sf_dir):
    return rounded(RP.by_year_month(B.flights_or(spark, sf_dir)))


@query
def period_compare(spark, sf_dir):
    return rounded(RP.period_compare(B.flights_or(spark, sf_dir), PERIODS, YEAR_A, YEAR_B))


@query
def period_rule(spark, sf_dir):
    return RP.period_rule(RP.period_compare(B.flights_or(spark, sf_dir), PERIODS, YEAR_A, YEAR_B), "jul-sep", "dec")


# ------------------------------------------------------------------ places
@query
def area_year(spark, sf_dir):
    return rounded(RP.area_year(enriched_or(spark, sf_dir), YEAR_A, YEAR_B, from_month=4))


@query
def place_change(spark, sf_dir):
    return rounded(RP.place_change(B.flights_or(spark, sf_dir), YEAR_A, YEAR_B, min_base=50))


def _place_stats(spark, sf_dir, area: str = "europe and around", min_n: int = 200) -> DataFrame:
    """A1e + J7: per-place summary joined (inner) to the looked-up place info."""
    stats = RP.summary(B.flights_or(spark, sf_dir), "place_code", min_n=min_n)
    info = LK.lookup_two_keys(stats.select("place_code"), places_geo(spark, sf_dir), "place_code", "key_a", "key_b",
                              ("name", "region", "lat", "lon", "distance_km", "area"), ["place_id"], "name")
    info = info.filter(F.col("matched_by").isNotNull()).drop("_code_in_a", "_code_in_b", "matched_by")
    j = stats.join(info, "place_code", "inner")
    return j.filter((F.col("area") == area) & F.col("lat").isNotNull())


@query
def place_stats(spark, sf_dir):
    return rounded(_place_stats(spark, sf_dir))


@query
def place_rank(spark, sf_dir):
    s = _place_stats(spark, sf_dir)
    return rounded(RP.ranked(s, [F.desc("late_pct"), F.asc("place_code")], 10))


@query
def color_limits(spark, sf_dir):
    return rounded(RP.color_limits(_place_stats(spark, sf_dir), "late_pct"))


@query
def place_month_series(spark, sf_dir):
    f = B.flights_or(spark, sf_dir).filter(F.col("place_code") == "NATION_7")
    return rounded(RP.month_series(f, *PLACE_MONTHS))


@query
def top_places(spark, sf_dir):
    """T4: the 60 busiest places with their looked-up attributes."""
    e = enriched_or(spark, sf_dir).filter(F.col("lat").isNotNull())
    agg = e.groupBy("place_code").agg(F.count(F.lit(1)).alias("n"), F.first("name", ignorenulls=True).alias("name"),
                                      F.first("lat", ignorenulls=True).alias("lat"),
                                      F.first("lon", ignorenulls=True).alias("lon"),
                                      F.first("distance_km", ignorenulls=True).alias("distance_km"))
    return rounded(RP.ranked(agg, [F.desc("n"), F.asc("place_code")], 60)
                   .withColumn("label", X.label_concat("place_code", "name")))


# ------------------------------------------------------------------ lookups
@query
def two_key_lookup(spark, sf_dir):
    e = enriched_or(spark, sf_dir)
    return rounded(e.select("order_key", "line_no", "place_code", "place_id", "name", "region", "lat", "lon", "matched_by"))


@query
def lookup_report(spark, sf_dir):
    return LK.lookup_report(B.flights_or(spark, sf_dir), places_geo(spark, sf_dir), "place_code", "key_a", "key_b",
                            ("name",), ["place_id"], "name")


@query
def unmatched_codes(spark, sf_dir):
    return LK.unmatched_codes(B.flights_or(spark, sf_dir), B.places(spark, sf_dir), "place_code", "key_a", "key_b",
                              "name", ["place_id"])


@query
def unknown_codes_text(spark, sf_dir):
    """The unresolved codes with their counts as one sorted text."""
    u = LK.unmatched_codes(B.flights_or(spark, sf_dir), B.places(spark, sf_dir), "place_code", "key_a", "key_b",
                           "name", ["place_id"])
    return LK.unmatched_text(u, "place_code")


@query
def join_cardinality(spark, sf_dir):
    """Rows before/after the lookup and the largest key multiplicity per key."""
    f = B.flights_or(spark, sf_dir)
    e = enriched_or(spark, sf_dir)
    n_in = f.select(F.count(F.lit(1))).scalar()
    out = e.agg(F.count(F.lit(1)).alias("rows_out")).select(n_in.alias("rows_in"), "rows_out")
    p = B.places(spark, sf_dir)
    ka = LK.key_multiplicity(p, "key_a").select(F.col("max_rows_per_key_a")).scalar()
    kb = LK.key_multiplicity(p, "key_b").select(F.col("max_rows_per_key_b")).scalar()
    return out.select("rows_in", "rows_out", ka.alias("max_rows_per_key_a"), kb.alias("max_rows_per_key_b"))


@query
def distance_area(spark, sf_dir):
    return rounded(places_geo(spark, sf_dir).select("place_id", "name", "distance_km", "area"))


# ------------------------------------------------------------------ weather reports
def _day_table(f: DataFrame) -> DataFrame:
    """Per day: flights, late flights, the day's weather (constant per day)."""
    return f.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_late").alias("n_late"),
        F.first("wpgt", ignorenulls=True).alias("wpgt"), F.first("prcp", ignorenulls=True).alias("prcp"),
        F.first("tavg", ignorenulls=True).alias("tavg"), F.first("tmin", ignorenulls=True).alias("tmin"))


@query
def weather_class_busy(spark, sf_dir):
    """Weather class × busy/quiet day — computed at day grain (weather and
    day load are per day), so no per-row window and no join back to rows."""
    f = LK.attach_daily(B.flights_ev(spark, sf_dir), B.weather_ev(spark, sf_dir)).filter(F.col("wpgt").isNotNull())
    d = _day_table(f)
    med = d.select(F.median("n")).scalar()
    d = d.withColumn("day_type", F.when(F.col("n") > med, F.lit("busy day")).otherwise(F.lit("quiet day")))
    d = d.withColumn("class_no", X.bin_number("wpgt", GUST_EDGES_EV, "left")).filter(F.col("class_no").isNotNull())
    out = d.groupBy("day_type", "class_no").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_days"),
        (F.sum("n_late") * F.lit(100.0) / F.sum("n")).alias("late_pct"))
    out = out.filter(F.col("n_days") >= 3).withColumn(
        "weather_class", X.ordinal_name("class_no", X.edge_labels(GUST_EDGES_EV, "left"), base=1))
    return rounded(out)


@query
def weather_classes(spark, sf_dir):
    """All six weather variables in their classes, split by busy and quiet days and unsplit."""
    f = LK.attach_daily(B.flights_ev(spark, sf_dir), B.weather_ev(spark, sf_dir))
    days = f.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_late").alias("n_late"),
                                *[F.first(v, ignorenulls=True).alias(v) for v in C.WEATHER_BINS])
    return rounded(RP.weather_classes(days, C.WEATHER_BINS))


@query
def last_per_series(spark, sf_dir):
    """The last day of every time-line series with its values."""
    t = RP.timeline(B.flights_ev(spark, sf_dir), "day", "direction", rolling=7, min_periods=4)
    return rounded(RP.last_per_series(t))


@query
def heat_weekday_hour_n(spark, sf_dir):
    """The second grid, flights per weekday and hour (6 to 22)."""
    return RP.heat_grid(B.flights_ev(spark, sf_dir), min_n=30, value="n")


@query
def day_weather(spark, sf_dir):
    """Per day n, % late and the day's weather, ≥ 50 flights; wind class."""
    f = LK.attach_daily(B.flights_ev(spark, sf_dir), B.weather_ev(spark, sf_dir))
    d = _day_table(f).filter(F.col("n") >= 50)
    return rounded(d.select("day", "n", (F.col("n_late") * F.lit(100.0) / F.col("n")).alias("late_pct"),
                            "wpgt", "prcp", "tavg", X.date_label("day").alias("day_label"),
                            X.bin_label("wpgt", GUST_EDGES_EV, None, "left").alias("wind_class")))


@query
def worst_days(spark, sf_dir):
    d = day_weather(spark, sf_dir)
    return RP.ranked(d, [F.desc("late_pct"), F.asc("day")], 10)


def _mean_gust(spark, sf_dir):
    """Mean daily gust, rounded so that no comparison hangs on the last bit of a sum."""
    return B.weather_ev(spark, sf_dir).select(F.round(F.avg("wpgt"), 6)).scalar()


@query
def cond_means(spark, sf_dir):
    """Conditional % late over rows (hour load, busy ∧ storm, frost) in one pass."""
    f = weathered_ev(spark, sf_dir)
    days = FE.day_counts(f)
    med = days.select(F.median("day_load")).scalar()
    f = f.join(sized_broadcast(materialize(days), DEFAULTS.broadcast_max_rows), "day", "left")
    busy_day = F.col("day_load") > med
    g = F.col("wpgt")
    load = f.select(F.avg("hour_load")).scalar()
    gust = _mean_gust(spark, sf_dir)
    return rounded(f.agg(
        RP.conditional_share((F.col("direction") == "departure") & (F.col("hour_load") > load * BUSY_SHARE)).alias("late_pct_busy_hours"),
        RP.conditional_share((F.col("direction") == "departure") & (F.col("hour_load") <= load * QUIET_SHARE)).alias("late_pct_quiet_hours"),
        RP.conditional_share(busy_day & (g >= gust * STORM_SHARE)).alias("late_pct_busy_storm"),
        RP.conditional_share(~busy_day & (g < gust * CALM_SHARE)).alias("late_pct_quiet_calm"),
        RP.conditional_share(F.col("frost")).alias("late_pct_frost"),
        RP.conditional_share(~F.col("frost")).alias("late_pct_no_frost"),
    ))


@query
def mean_of_day_shares(spark, sf_dir):
    """Unweighted mean of per-day % late for stormy and calm days."""
    f = LK.attach_daily(B.flights_ev(spark, sf_dir), B.weather_ev(spark, sf_dir))
    d = _day_table(f).withColumn("share", F.col("n_late") / F.col("n"))
    gust = _mean_gust(spark, sf_dir)
    return rounded(d.agg((F.avg(F.when(F.col("wpgt") >= gust * STORM_SHARE, F.col("share"))) * 100).alias("storm_day_late_pct"),
                         (F.avg(F.when(F.col("wpgt") < gust * CALM_SHARE, F.col("share"))) * 100).alias("calm_day_late_pct")))


@query
def fixed_findings(spark, sf_dir):
    """A13 + A14: the findings of one base year from one table of counts."""
    return rounded(RP.fixed_findings(weathered_ev(spark, sf_dir), 2024, busy_load=14, quiet_load=120, storm=200.0, calm_day=300.0, calm=300.0))


# ------------------------------------------------------------------ delay distribution
@query
def delay_histogram(spark, sf_dir):
    return rounded(RP.histogram(B.flights_ev(spark, sf_dir), "delay_min"))


@query
def delay_quantiles(spark, sf_dir):
    return rounded(RP.quantiles(B.flights_ev(spark, sf_dir), "delay_min", (0.25, 0.75, 0.99), ("q25", "q75", "q99")))


# ------------------------------------------------------------------ profiles
@query
def column_profile(spark, sf_dir):
    return rounded(PR.column_profile(B.raw_ev_ordered(spark, sf_dir), order="_order"))


# fixed texts of the NULL-reason labels
NULL_REASONS = {"place_code": "no code in the source", "direction": "code other than departure/arrival"}
NULL_REASON_OTHER = "flight without a matched place"


@query
def null_profile(spark, sf_dir):
    """NULLs per column of the enriched fact, with a reason label."""
    return rounded(PR.null_profile(enriched_or(spark, sf_dir), NULL_REASONS, NULL_REASON_OTHER))


@query
def weather_coverage(spark, sf_dir):
    """% of flights with the day's weather attached (and with a gust value)."""
    f = LK.attach_daily(B.flights_ev(spark, sf_dir), B.weather_ev(spark, sf_dir))
    return rounded(PR.coverage(f, {"pct_with_weather": F.col("tavg").isNotNull(),
                                   "pct_with_gust": F.col("wpgt").isNotNull()}))


@query
def area_share(spark, sf_dir):
    """Share of all flights per area (NULL area = no matched place)."""
    e = enriched_or(spark, sf_dir)
    total = e.select(F.count(F.lit(1))).scalar()
    return rounded(e.groupBy("area").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("share_pct", F.col("n") * F.lit(100.0) / total))


@query
def value_freq(spark, sf_dir):
    return PR.value_freq(B.flights_or(spark, sf_dir), "aircraft")


@query
def source_summary(spark, sf_dir):
    return PR.source_summary(B.weather_ev(spark, sf_dir))


@query
def coverage(spark, sf_dir):
    e = enriched_or(spark, sf_dir)
    return rounded(PR.coverage(e, {"pct_with_place": F.col("name").isNotNull(),
                                   "pct_with_code": F.col("place_code").isNotNull(),
                                   "pct_departure": F.col("direction") == "departure"}))


# ------------------------------------------------------------------ model features
@query
def features(spark, sf_dir):
    f = FE.add_load_features(B.flights_ev(spark, sf_dir))
    return rounded(f.select("flight_id", "day", "hour", "hour_load", "day_load", "prev_hour_delay"))


@query
def top_categories(spark, sf_dir):
    return FE.top_categories(B.flights_ev(spark, sf_dir), k=30)


@query
def encode_other(spark, sf_dir):
    f = B.flights_ev(spark, sf_dir)
    top = FE.top_categories(f, k=30)
    return FE.encode_other(f.select("flight_id", *C.CATEGORICAL), top)


# ------------------------------------------------------------------ splits and evaluation
@query
def split_days(spark, sf_dir):
    return EV.day_split(B.flights_ev(spark, sf_dir))


@query
def split_year(spark, sf_dir):
    return EV.split_summary(EV.year_split(B.flights_or(spark, sf_dir), YEAR_A, YEAR_B))


@query
def baseline(spark, sf_dir):
    s = B.scored_ev(spark, sf_dir)
    return rounded(EV.baseline(EV.with_split(s, EV.day_split(s))))


@query
def metrics(spark, sf_dir):
    return rounded(EV.score_metrics(test_scored(spark, sf_dir)))


@query
def auc(spark, sf_dir):
    return rounded(EV.auc(test_scored(spark, sf_dir)))


@query
def calibration(spark, sf_dir):
    return rounded(EV.calibration(test_scored(spark, sf_dir)))


@query
def confusion_sweep(spark, sf_dir):
    return rounded(EV.confusion_sweep(test_scored(spark, sf_dir)))


@query
def pred_by_day(spark, sf_dir):
    t = LK.attach_daily(test_scored(spark, sf_dir), B.weather_ev(spark, sf_dir))
    return rounded(EV.by_day(t, min_n=150))


@query
def top_misses(spark, sf_dir):
    t = LK.attach_daily(test_scored(spark, sf_dir), B.weather_ev(spark, sf_dir))
    return rounded(RP.ranked(EV.by_day(t, min_n=150), [F.desc("error"), F.asc("day")], 3))


@query
def pred_by_hour(spark, sf_dir):
    return rounded(EV.by_hour(test_scored(spark, sf_dir), min_n=100))


@query
def pred_by_delay_class(spark, sf_dir):
    return rounded(EV.by_delay_class(test_scored(spark, sf_dir)))


@query
def pred_heavy(spark, sf_dir):
    """Mean predicted chance (%) for flights that were ≥ 60 minutes late."""
    t = test_scored(spark, sf_dir).filter(F.col("delay_min") >= 60)
    return rounded(t.agg((F.avg("p_late") * 100).alias("pred_pct"), F.count(F.lit(1)).alias("n")))


@query
def pred_worst_hour(spark, sf_dir):
    """M14 + T6: the hour with the largest gap between actual and predicted."""
    h = EV.by_hour(test_scored(spark, sf_dir), min_n=50)
    return rounded(RP.ranked(h, [F.desc("abs_gap"), F.asc("hour")], 1))


@query
def pred_overall(spark, sf_dir):
    return rounded(EV.overall(test_scored(spark, sf_dir)))


@query
def skill(spark, sf_dir):
    s = B.scored_ev(spark, sf_dir)
    return rounded(EV.skill(EV.with_split(s, EV.day_split(s))))


# ------------------------------------------------------------------ presentation
@query
def format_report(spark, sf_dir):
    s = RP.summary(B.flights_or(spark, sf_dir), "airline", min_n=100)
    return s.select("airline", X.nl_number("n", 0).alias("n_text"), X.nl_number("late_pct", 1).alias("late_pct_text"),
                    X.nl_number("avg_delay", 1).alias("avg_delay_text"),
                    X.label_concat("airline", X.nl_number("n", 0)).alias("label"))


@query
def rounded_report(spark, sf_dir):
    """The airline table with the digits that reports show."""
    s = RP.summary(B.flights_or(spark, sf_dir), "airline")
    return RP.report_round(s.select("airline", "n", "avg_delay", "late_pct"), {"avg_delay": 2, "late_pct": 1})


@query
def selection_text(spark, sf_dir):
    """What was chosen and how many flights are left, as one line."""
    return RP.selection_text(B.flights_or(spark, sf_dir), YEAR_A, "departure", ("Brand#11", "Brand#22"))


# ------------------------------------------------------------------ models (rows-only checks)
# Up to 120 boosting rounds; a tenth of the training days decides when to stop.
MODEL_PARAMS = DEFAULTS
_FITTED: dict = {}


def _model_key(spark, sf_dir, params) -> tuple:
    """A fitted model belongs to one session, one folder and all parameters."""
    return spark.sparkContext.applicationId, sf_dir, params


#: Columns by which the model's rows are dealt to partitions.
DEAL_BY = ("flight_id", "planned_ts", "delay_min")


def model_table(spark, sf_dir, deal: bool = False) -> DataFrame:
    """M1: flights_ev + load/day/previous-hour features + place + daily weather.

    ``deal``: in partitions of bounded size from the first join on, for a caller that needs all columns."""
    f = FE.add_load_features(B.flights_ev(spark, sf_dir))
    f = deal_rows(f, DEAL_BY) if deal else f
    f = LK.lookup_two_keys(f, places_geo(spark, sf_dir), "place_code", "key_a", "key_b",
                           ("lat", "lon", "distance_km"), ["place_id"], "lat")
    f = f.drop("_code_in_a", "_code_in_b", "matched_by")
    return LK.attach_daily(f, B.weather_ev(spark, sf_dir))


def _split_model_table(spark, sf_dir, params=MODEL_PARAMS, categories_from: str = "train"):
    """M3 split, then the category lists (T5) — fitted on train only by default
    (no leakage); ``categories_from='all'`` reproduces lists computed on all rows."""
    from punctuo.operators import predict as PD
    # the iterative fits scan the prepared table many times: write it once
    # (Parquet in the shared checkpoint folder, short lineage, columnar reads)
    # and cache both sides, as usual before fitting iterative Spark ML models;
    # files are read back packed by bytes, so both sides are dealt by rows
    t = model_table(spark, sf_dir, deal=True)
    t = checkpoint_table(EV.with_split(t, EV.day_split(t, params.test_share, params.seed)))
    source = t if categories_from == "all" else t.filter(~F.col("is_test"))
    top = FE.top_categories(source, list(params.categorical), params.max_categories)
    t = PD.cap_categories(t, top, params)
    return persist_table(deal_rows(t.filter(~F.col("is_test")), DEAL_BY)), persist_table(deal_rows(t.filter(F.col("is_test")), DEAL_BY))


_SPLITS: dict = {}


def _split_cached(spark, sf_dir, params=MODEL_PARAMS):
    key = _model_key(spark, sf_dir, params)
    if key not in _SPLITS:
        _SPLITS[key] = _split_model_table(spark, sf_dir, params)
    return _SPLITS[key]


def _fitted(spark, sf_dir, params=MODEL_PARAMS):
    """Fit once per (data, parameters) in this process; later queries reuse it."""
    from punctuo.operators import predict as PD
    key = _model_key(spark, sf_dir, params)
    if key not in _FITTED:
        train, _ = _split_cached(spark, sf_dir, params)
        models, prep = PD.fit_ladder(train, params)  # its metrics are the query ``ladder``'s
        _, cols, clf = models[-1]
        reg = PD.fit_regressor(train, cols, params, prep)
        _FITTED[key] = {"models": models, "cols": cols, "clf": clf, "reg": reg}
    return _FITTED[key]


@query
def ladder(spark, sf_dir):
    from punctuo.operators import predict as PD
    train, test = _split_cached(spark, sf_dir)
    fitted = _fitted(spark, sf_dir)
    return rounded(PD.ladder_rows(fitted["models"], test, MODEL_PARAMS))


@query
def minutes_model(spark, sf_dir):
    from punctuo.operators import predict as PD
    _, test = _split_cached(spark, sf_dir)
    fitted = _fitted(spark, sf_dir)
    pred = PD.predict_minutes(fitted["reg"], test, fitted["cols"], MODEL_PARAMS)
    return rounded(EV.score_metrics(pred.withColumn("p_late", F.lit(0.0)))).select("n", "mae", "r2")


@query
def importance(spark, sf_dir):
    from punctuo.operators import predict as PD
    _, test = _split_cached(spark, sf_dir)
    fitted = _fitted(spark, sf_dir)
    return rounded(PD.permutation_importance(fitted["clf"], test, fitted["cols"], MODEL_PARAMS))


@query
def importance_formula(spark, sf_dir):
    """M8 over all test rows, with a formula in place of the model."""
    t = test_scored(spark, sf_dir).select("flight_id", "is_late", "hour", "weekday", (F.col("flight_id") % 17).alias("slot"))
    formula = F.round((F.col("hour") * 4 + F.col("weekday") * 3 + F.col("slot")) / F.lit(140.0), 4)
    return rounded(EV.permuted_auc_drop(t, ["hour", "weekday", "slot"], lambda d: d.withColumn("p_late", formula), "flight_id"))


@query
def scored_test(spark, sf_dir):
    """M9: the test rows with chance and expected minutes."""
    from punctuo.operators import predict as PD
    _, test = _split_cached(spark, sf_dir)
    fitted = _fitted(spark, sf_dir)
    cols = fitted["cols"]
    s = PD.score(fitted["clf"], test, cols, MODEL_PARAMS).select("flight_id", "p_late")
    m = PD.predict_minutes(fitted["reg"], test, cols, MODEL_PARAMS).select("flight_id", "pred_min")
    keep = ["flight_id", "day", "year", "hour", "direction", "hour_load", "runway", "wpgt", "prcp", "tavg",
            "delay_min", "is_late", "prev_hour_delay"]
    return rounded(test.select(*keep).join(s, "flight_id").join(m, "flight_id"))


@query
def whatif_places(spark, sf_dir):
    """M17 + C37: batch what-if — one departure scenario per busy place (the 60
    busiest) with given conditions; the rest derived from them."""
    from punctuo.operators import predict as PD
    fitted = _fitted(spark, sf_dir)
    t = model_table(spark, sf_dir).filter(F.col("lat").isNotNull())
    places = t.groupBy("place_code").agg(F.count(F.lit(1)).alias("n"), F.first("lat", ignorenulls=True).alias("lat"),
                                         F.first("lon", ignorenulls=True).alias("lon"),
                                         F.first("distance_km", ignorenulls=True).alias("distance_km"))
    places = RP.ranked(places, [F.desc("n"), F.asc("place_code")], 60)
    s = places.select("place_code", "lat", "lon", "distance_km",
                      F.lit("departure").alias("direction"), F.lit("A1").alias("airline"), F.lit("view").alias("aircraft"),
                      F.lit("R1").alias("runway"), F.lit(17).alias("hour"), F.lit(4).alias("weekday"), F.lit(1).alias("month"),
                      F.lit(20).alias("hour_load"), F.lit(330).alias("day_load"), F.lit(18.0).alias("tavg"),
                      F.lit(0.0).alias("prcp"), F.lit(35.0).alias("wpgt"), F.lit(10.0).alias("prev_hour_delay"),
                      F.lit(None).cast("double").alias("delay_min"), F.lit(None).cast("boolean").alias("is_late"))
    s = PD.whatif_defaults(s)
    scored = PD.score(fitted["clf"], s, fitted["cols"], MODEL_PARAMS)
    scored = PD.predict_minutes(fitted["reg"], PD.drop_work(scored), fitted["cols"], MODEL_PARAMS)
    return rounded(scored.select("place_code", "distance_km", "p_late", "pred_min"))


@query
def whatif_hours(spark, sf_dir):
    """M17 + M18: the test flights re-scored at every hour 6..22."""
    from punctuo.operators import predict as PD
    _, test = _split_cached(spark, sf_dir)
    fitted = _fitted(spark, sf_dir)
    return rounded(PD.hour_sweep(fitted["clf"], test, fitted["cols"], params=MODEL_PARAMS))
