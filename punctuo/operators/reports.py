"""Reports over the clean fact (A1–A14, A24–A28, P*, T*, J12, J13, U*).

Conventions (SURVEY §1.5): NULL group keys are dropped; ``n`` counts rows
(missing delays included); late_pct = mean of the non-NULL ``is_late`` × 100;
median is exact and interpolated, computed from (group, value) counts so a
hot group is not merged in one task (sketches via ``exact=False``:
``percentile_approx``, ``approx_count_distinct``).
Comparisons between years or periods are conditional aggregates in one pass
instead of one filtered job per year.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuo import config as C
from punctuo.functions import columns as X
from punctuo.operators.quantiles import exact_quantiles, grouped_quantiles, median_table, reads_all
from punctuo.operators.util import non_null


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def median_of(c, exact: bool = True) -> Column:
    return F.median(c) if exact else F.percentile_approx(c, 0.5, 10_000)


def distinct_of(c, exact: bool = True) -> Column:
    """Exact distinct count, or an HLL++ sketch (no Expand, mergeable) at scale."""
    return F.count_distinct(c) if exact else F.approx_count_distinct(c, 0.01)


def summary_aggs(delay: str = "delay_min", flag: str = "is_late", exact: bool = True) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(delay).alias("avg_delay"),
        median_of(F.col(delay), exact).alias("median_delay"),
        (F.avg(F.col(flag).cast("double")) * F.lit(100.0)).alias("late_pct"),
    ]


def value_count_summary(base: DataFrame, keys: Sequence[str], delay: str = "delay_min", flag: str = "is_late",
                        counts: dict[str, Column] | None = None) -> DataFrame:
    """n, mean, exact median and % late per group from ONE (group, value) count
    table (``quantiles.grouped_quantiles``): the counting shuffles by (group, value)
    and the median is selected by value ranges, so a hot group is spread over
    tasks. ``counts``: extra conditional row counts per group."""
    keys = list(keys)
    counts = counts or {}
    vc = base.groupBy(*keys, delay).agg(
        F.count(F.lit(1)).alias("_c"), F.count_if(F.col(flag)).alias("_late"), F.count(flag).alias("_flag"),
        *[F.count_if(cond).alias(f"_k_{name}") for name, cond in counts.items()])
    v = F.col(delay)
    sums = {"n": F.col("_c"), "_sum": v * F.col("_c"), "_values": F.when(v.isNotNull(), F.col("_c")), "_lates": F.col("_late"), "_flags": F.col("_flag"),
            **{name: F.col(f"_k_{name}") for name in counts}}
    agg = grouped_quantiles(vc, keys, delay, [0.5], sums)
    return agg.select(*keys, "n", (F.col("_sum") / F.col("_values")).alias("avg_delay"), F.col("q")[0].alias("median_delay"),
                      (F.col("_lates") * F.lit(100.0) / F.when(F.col("_flags") > 0, F.col("_flags"))).alias("late_pct"), *counts)


def place_summary(base: DataFrame, keys: Sequence[str], place: str = "place_code", delay: str = "delay_min", flag: str = "is_late") -> DataFrame:
    """n, % late, mean and exact median delay and exact distinct places per group, from ONE
    count table over (group, place, delay) that is made once and read by both parts.

    The places of a group are counted over its distinct (group, place) pairs, so no row is
    expanded for them and a busy place is combined before the shuffle. ``keys`` must not be
    NULL; without keys one row, also of an empty selection."""
    keys = list(keys)
    vc = base.groupBy(*keys, place, delay).agg(F.count(F.lit(1)).alias("_c"), F.count_if(F.col(flag)).alias("_late"), F.count(flag).alias("_flag"))
    v = F.col(delay)
    sums = {"n": F.col("_c"), "_sum": v * F.col("_c"), "_values": F.when(v.isNotNull(), F.col("_c")), "_lates": F.col("_late"), "_flags": F.col("_flag")}
    stats = grouped_quantiles(vc, keys, delay, [0.5], sums)
    pairs = vc.filter(reads_all(["_c", "_late", "_flag"])).groupBy(*keys, place).agg(F.sum("_c").alias("_c"))
    n_places = F.count(place).alias("n_places")
    if keys:
        stats, places = stats.join(pairs.groupBy(*keys).agg(n_places), keys, "left"), F.col("n_places")
    else:
        places = pairs.agg(n_places).scalar()
    return stats.select(*keys, F.coalesce("n", F.lit(0)).alias("n"),
                        (F.col("_lates") * F.lit(100.0) / F.when(F.col("_flags") > 0, F.col("_flags"))).alias("late_pct"),
                        (F.col("_sum") / F.col("_values")).alias("avg_delay"), F.col("q")[0].alias("median_delay"), places.alias("n_places"))


def summary(df: DataFrame, keys, min_n: int | None = None, delay: str = "delay_min", flag: str = "is_late",
            exact: bool = True) -> DataFrame:
    """A1: n, mean, median delay and % late per group; P7 minimum support."""
    keys = _keys(keys)
    base = non_null(df, keys)
    if exact:
        out = value_count_summary(base, keys, delay, flag)
    else:
        out = base.groupBy(*keys).agg(*summary_aggs(delay, flag, exact))
    return out if min_n is None else out.filter(F.col("n") >= F.lit(min_n))


def apply_filters(df: DataFrame, direction: str | None = None, airlines: Sequence[str] = (),
                  aircraft: Sequence[str] = (), year: int | None = None) -> DataFrame:
    """P1 + P2: optional equality / IN filters; an empty choice means no filter."""
    if direction:
        df = df.filter(F.col("direction") == direction)
    if airlines:
        df = df.filter(F.col("airline").isin(list(airlines)))
    if aircraft:
        df = df.filter(F.col("aircraft").isin(list(aircraft)))
    if year is not None:
        df = df.filter(F.col("year") == year)
    return df


def headline(df: DataFrame, place: str = "place_code", exact: bool = True) -> DataFrame:
    """A3: totals of a selection (one row)."""
    if exact:
        return place_summary(df, [], place)
    return df.agg(*_place_aggs(place))


def _place_aggs(place: str) -> list[Column]:
    """The measures of ``place_summary`` with sketches for the median and the places."""
    return [F.count(F.lit(1)).alias("n"), (F.avg(F.col("is_late").cast("double")) * 100).alias("late_pct"), F.avg("delay_min").alias("avg_delay"),
            median_of(F.col("delay_min"), False).alias("median_delay"), distinct_of(F.col(place), False).alias("n_places")]


def headline_delta(df: DataFrame, year: int, other: int, place: str = "place_code", exact: bool = True) -> DataFrame:
    """A4: headline of ``year`` and the difference with ``other``, both from the per-year table.

    Differences are NULL when the other year has no rows."""
    y = F.col("year")
    s = by_year(df.filter(y.isin(year, other)), place, exact)
    at = lambda of, m: F.max(F.when(y == of, F.col(m)))
    counts, measures = ("n", "n_places"), ("n", "late_pct", "avg_delay", "median_delay", "n_places")
    cell = lambda of, m: F.coalesce(at(of, m), F.lit(0)) if m in counts else at(of, m)
    one = s.agg(*[cell(of, m).alias(f"{m}_{tag}") for of, tag in ((year, "sel"), (other, "oth")) for m in measures])
    diffs = [F.when(F.col("n_oth") > 0, F.col(f"{m}_sel") - F.col(f"{m}_oth")).alias(f"diff_{m}") for m in measures]
    return one.select(*[f"{m}_sel" for m in measures], *diffs)


def by_year(df: DataFrame, place: str = "place_code", exact: bool = True) -> DataFrame:
    """A5: per year n, % late, mean, median, distinct places."""
    base = non_null(df, ["year"])
    return place_summary(base, ["year"], place) if exact else base.groupBy("year").agg(*_place_aggs(place))


def year_delta(df: DataFrame, year_a: int, year_b: int, place: str = "place_code", min_rows: int = 50, exact: bool = True) -> DataFrame:
    """A5 + P8: every measure of ``by_year`` in two years and the difference, one row per measure.

    No rows if the selection has fewer than ``min_rows`` rows or one of the years is
    missing from it. Only the two years are read; the pivot is over two rows."""
    measures = ["n", "late_pct", "avg_delay", "median_delay", "n_places"]
    s = by_year(df.filter(F.col("year").isin(year_a, year_b)), place, exact)
    at = lambda y, m: F.max(F.when(F.col("year") == y, F.col(m).cast("double")))
    cells = [F.struct(F.lit(i).alias("measure_no"), F.lit(m).alias("measure"), at(year_a, m).alias("value_a"), at(year_b, m).alias("value_b")) for i, m in enumerate(measures, 1)]
    one = s.agg(F.array(*cells).alias("_cells"), F.count("year").alias("_years"), F.sum("n").alias("_rows"))
    rows = one.filter((F.col("_years") == 2) & (F.col("_rows") >= min_rows)).select(F.inline("_cells"))
    return rows.withColumn("delta", F.col("value_b") - F.col("value_a"))


def by_year_month(df: DataFrame, place: str = "place_code", exact: bool = True) -> DataFrame:
    """Per (year, month) n, % late, mean delay, distinct places."""
    return non_null(df, ["year", "month"]).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"),
        (F.avg(F.col("is_late").cast("double")) * 100).alias("late_pct"),
        F.avg("delay_min").alias("avg_delay"),
        distinct_of(F.col(place), exact).alias("n_places"),
    )


def period_compare(df: DataFrame, periods: dict[str, Sequence[int]], year_a: int, year_b: int) -> DataFrame:
    """A7 + U1 + C27: per period (a set of months) n and % late of two years.

    Rows fan out to the periods they belong to (periods may overlap) and are
    aggregated once; measures are NULL unless both years are present."""
    m, y = F.col("month"), F.col("year")
    tags = F.filter(F.array(*[F.when(m.isin(list(ms)), F.lit(name)) for name, ms in periods.items()]),
                    lambda t: t.isNotNull())
    a, b = y == year_a, y == year_b
    agg = (df.filter(y.isin(year_a, year_b)).select(F.explode(tags).alias("period"), "year", "is_late")
             .groupBy("period").agg(
                 F.count_if(a).alias("_na"), F.count_if(b).alias("_nb"),
                 F.avg(F.when(a, F.col("is_late").cast("double"))).alias("_la"),
                 F.avg(F.when(b, F.col("is_late").cast("double"))).alias("_lb")))
    both = (F.col("_na") > 0) & (F.col("_nb") > 0)
    return agg.select(
        "period",
        F.when(both, F.col("_na")).alias("n_a"), F.when(both, F.col("_nb")).alias("n_b"),
        F.when(both, F.col("_la") * 100).alias("late_pct_a"), F.when(both, F.col("_lb") * 100).alias("late_pct_b"),
        F.when(both, X.ratio_pct("_na", "_nb")).alias("n_ratio_pct"),
    )


def period_rule(compare: DataFrame, summer: str, winter: str, low: float = 0.4, high: float = 0.6) -> DataFrame:
    """Summer share fell below ``low``× and winter share stayed above ``high``×."""
    p = F.col("period")
    return compare.agg(
        F.max(F.when(p == summer, F.col("late_pct_b") < F.col("late_pct_a") * low)).alias("_s"),
        F.max(F.when(p == winter, F.col("late_pct_b") > F.col("late_pct_a") * high)).alias("_w"),
    ).select(F.coalesce(F.col("_s") & F.col("_w"), F.lit(False)).alias("summer_peak_removed"))


def area_year(df: DataFrame, year_a: int, year_b: int, from_month: int = 4, area: str = "area",
              place: str = "place_code", exact: bool = True) -> DataFrame:
    """Per area flights and distinct places in two years and what remained (%)."""
    y = F.col("year")
    a, b = y == year_a, y == year_b
    base = non_null(df, [area]).filter((F.col("month") >= from_month) & y.isin(year_a, year_b))
    if exact:  # through (area, place) counts: no row is expanded for the two distinct counts
        pairs = base.groupBy(area, place).agg(F.count_if(a).alias("_a"), F.count_if(b).alias("_b"))
        known = F.col(place).isNotNull()
        agg = pairs.groupBy(area).agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b"), F.count_if(known & (F.col("_a") > 0)).alias("places_a"),
                                      F.count_if(known & (F.col("_b") > 0)).alias("places_b"))
    else:
        agg = base.groupBy(area).agg(F.count_if(a).alias("n_a"), F.count_if(b).alias("n_b"),
                                     distinct_of(F.when(a, F.col(place)), False).alias("places_a"), distinct_of(F.when(b, F.col(place)), False).alias("places_b"))
    return (agg.filter((F.col("n_a") > 0) & (F.col("n_b") > 0))
               .withColumn("n_kept_pct", X.ratio_pct("n_a", "n_b"))
               .withColumn("places_kept_pct", X.ratio_pct("places_a", "places_b")))


def place_change(df: DataFrame, year_a: int, year_b: int, min_base: int, place: str = "place_code",
                 exact: bool = True) -> DataFrame:
    """A10 + A1e + C26: per place the summary, the counts in two years and the % change,
    with minimum support in the base year (counts are conditional, no join)."""
    y = F.col("year")
    base = non_null(df, [place])
    counts = [F.count_if(y == year_a).alias("n_a"), F.count_if(y == year_b).alias("n_b")]
    if exact:
        out = value_count_summary(base, [place], counts={"n_a": y == year_a, "n_b": y == year_b})
    else:
        out = base.groupBy(place).agg(*summary_aggs(exact=False), *counts)
    return out.filter(F.col("n_a") >= min_base).withColumn("change_pct", X.pct_change("n_a", "n_b"))


def timeline(df: DataFrame, unit: str = "day", split: str | None = "direction", rolling: int | None = None,
             min_periods: int = 4, day: str = "day") -> DataFrame:
    """A2 + U2 + W4: per time bucket n, mean delay, % late — for all rows and per
    ``split`` value in ONE aggregation (grouping sets (bucket, split) and
    (bucket)); empty buckets never appear.

    ``rolling``: centered mean over that many rows of the series (not calendar
    days), NULL below ``min_periods`` values."""
    if unit == "day":
        bucket = F.col(day)
    else:
        bucket = F.to_date(F.date_trunc(unit, F.col(day)))
    base = df.select(bucket.alias("bucket"), *( [F.col(split).alias("_split")] if split else []),
                     "delay_min", "is_late")
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("delay_min").alias("avg_delay"),
            (F.avg(F.col("is_late").cast("double")) * 100).alias("late_pct")]
    base = base.filter(F.col("bucket").isNotNull())
    if split:
        g = base.groupingSets([["bucket", "_split"], ["bucket"]], "bucket", "_split").agg(
            *aggs, F.grouping("_split").alias("_g"))
        g = g.filter((F.col("_g") == 1) | F.col("_split").isNotNull())
        out = g.select(F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col("_split")).alias("series"),
                       "bucket", "n", "avg_delay", "late_pct")
    else:
        out = base.groupBy("bucket").agg(*aggs).select(F.lit("all").alias("series"), "bucket", "n", "avg_delay", "late_pct")
    if rolling:
        half = rolling // 2
        w = Window.partitionBy("series").orderBy("bucket").rowsBetween(-half, half)
        for m in ("late_pct", "avg_delay"):
            out = out.withColumn(f"{m}_roll", F.when(F.count(m).over(w) >= min_periods, F.avg(m).over(w)))
    return out


def last_per_series(t: DataFrame, series: str = "series", bucket: str = "bucket") -> DataFrame:
    """The last bucket of every series of a time line, with its values."""
    rest = [c for c in t.columns if c not in (series, bucket)]
    last = t.groupBy(series).agg(F.max(bucket).alias(bucket), F.max_by(F.struct(*rest), bucket).alias("_last"))
    return last.select(series, bucket, *[F.col(f"_last.{c}").alias(c) for c in rest])


def heat_grid(df: DataFrame, min_n: int, hours: Sequence[int] = tuple(range(6, 23)), value: str = "late_pct",
              exact: bool = True) -> DataFrame:
    """A1c + P4 + A26 + J13: weekday × hour grid of ``value``; all 7 weekdays
    present, missing cells NULL. The pivot values are given, so no extra job, and
    medians are selected only where they are the value shown."""
    s = summary(df, ["weekday", "hour"], min_n, exact=exact and value == "median_delay").filter(F.col("hour").between(min(hours), max(hours)))
    grid = s.groupBy("weekday").pivot("hour", list(hours)).agg(F.first(value))
    grid = grid.select("weekday", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    spine = df.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday"))
    return (spine.join(grid, "weekday", "left")
                 .withColumn("weekday_name", X.ordinal_name("weekday", C.WEEKDAY_NAMES, base=0))
                 .select("weekday", "weekday_name", *[f"h{h:02d}" for h in hours]))


def top_groups(df: DataFrame, key: str, min_n: int, top: int, exact: bool = True) -> DataFrame:
    """A1d + T1: the ``top`` largest groups (ties by key) with their summary, and
    ``late_rank``, their place when sorted by % late (ties by key)."""
    t = summary(df, key, min_n, exact=exact).orderBy(F.desc("n"), F.asc(key)).limit(top)
    return t.withColumn("late_rank", F.row_number().over(Window.orderBy(F.desc("late_pct"), F.asc(key)))).orderBy("late_rank")


def ranked(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows in an explicit total order (top-n, no global sort)."""
    return df.orderBy(*order).limit(n)


def arg_extremes(agg: DataFrame, value: str, keys: Sequence[str], label: str) -> DataFrame:
    """The row with the highest and the lowest ``value`` (ties: first by keys).

    ``agg`` is an aggregated table (a few hundred rows at most)."""
    key_struct = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    hi = agg.orderBy(F.desc(value), *[F.asc(k) for k in keys]).limit(1).select(
        F.lit(f"max_{label}").alias("kind"), key_struct.alias("key"), F.col(value).alias("value"))
    lo = agg.orderBy(F.asc(value), *[F.asc(k) for k in keys]).limit(1).select(
        F.lit(f"min_{label}").alias("kind"), key_struct.alias("key"), F.col(value).alias("value"))
    return hi.unionByName(lo)


def month_series(df: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """A27 + J12: per calendar month n and % late on a dense month spine; the
    spine fills 0 for every measure (late_pct included)."""
    m = df.groupBy(F.trunc(F.col(day), "month").alias("month_start")).agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.col("is_late").cast("double")) * 100).alias("late_pct"))
    spine = df.sparkSession.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return spine.join(m, "month_start", "left").na.fill(0, ["n"]).na.fill(0.0, ["late_pct"])


def histogram(df: DataFrame, c: str = "delay_min", lo: float = C.HIST_LO, hi: float = C.HIST_HI,
              width: float = C.HIST_WIDTH) -> DataFrame:
    """Clip, fixed-width bins, count (partial aggregation), every bin present."""
    import math
    n_bins = int(math.floor((hi - lo) / width)) + 1
    counts = (df.select(X.histogram_bin(c, lo, hi, width).alias("bin_no")).filter(F.col("bin_no").isNotNull())
                .groupBy("bin_no").agg(F.count(F.lit(1)).alias("n")))
    spine = df.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin_no"))
    return (spine.join(counts, "bin_no", "left").na.fill(0, ["n"])
                 .withColumn("bin_lo", F.lit(lo) + F.col("bin_no") * F.lit(width))
                 .withColumn("bin_hi", F.col("bin_lo") + F.lit(width))
                 .select("bin_no", "bin_lo", "bin_hi", "n"))


def quantiles(df: DataFrame, c: str, qs: Sequence[float], names: Sequence[str], exact: bool = True) -> DataFrame:
    """Exact interpolated quantiles (one aggregation), plus the maximum."""
    if exact:
        q = exact_quantiles(df, c, qs)
        return q.select(*[F.col("q")[i].alias(nm) for i, nm in enumerate(names)],
                        df.select(F.max(c)).scalar().alias(f"max_{c}"))
    arr = F.array(*[F.lit(float(x)) for x in qs])
    agg = df.agg(F.percentile_approx(F.col(c), arr, 10_000).alias("_q"), F.max(c).alias(f"max_{c}"))
    return agg.select(*[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)], f"max_{c}")


def color_limits(df: DataFrame, value: str, lo_q: float = 0.05, hi_q: float = 0.95) -> DataFrame:
    """Floor of the low quantile, ceil of the high one, widened if equal."""
    agg = df.agg(F.percentile(value, lo_q).alias("_lo"), F.percentile(value, hi_q).alias("_hi"))
    lo, hi = F.floor("_lo").cast("double"), F.ceil("_hi").cast("double")
    return agg.select(lo.alias("color_lo"), F.when(lo == hi, hi + 1).otherwise(hi).alias("color_hi"))


def conditional_share(cond: Column, flag: str = "is_late") -> Column:
    """A13 building block: % late among rows where ``cond`` holds (one pass)."""
    return F.avg(F.when(cond, F.col(flag).cast("double"))) * F.lit(100.0)


def fixed_findings(fact: DataFrame, base_year: int, busy_load: float = 60, quiet_load: float = 40, storm: float = 60, calm_day: float = 30,
                   calm: float = 40, departure: str = "departure") -> DataFrame:
    """A13 + A14: the findings of one base year, one row, whatever selection a user made.

    % late of departures in busy (``hour_load`` above ``busy_load``) and quiet hours (up to
    ``quiet_load``); mean of the per-day shares on stormy (``wpgt`` from ``storm``) and calm
    days (below ``calm_day``); % late on busy stormy and quiet calm days (busy: more flights
    than the median day; calm: below ``calm``) and with and without frost.

    Rows are counted once per (day, direction, hour load); all findings are read off these
    counts, of which a day has a few dozen. A finding without a row is NULL."""
    base = fact.filter(F.col("year") == base_year)
    cells = base.groupBy("day", "direction", "hour_load").agg(
        F.count(F.lit(1)).alias("_n"), F.count("is_late").alias("_flags"), F.count_if("is_late").alias("_late"),
        F.max("wpgt").alias("_gust"), F.max(F.coalesce("frost", F.lit(False))).alias("_frost"))
    day = Window.partitionBy("day")
    cells = cells.withColumns({"_load": F.sum("_n").over(day), "_wpgt": F.max("_gust").over(day), "_first": F.row_number().over(day.orderBy("direction", "hour_load")) == 1,
                               "_share": F.sum("_late").over(day) / F.sum("_flags").over(day)})
    usual = F.median(F.when(F.col("_first"), F.col("_load")))  # one value a day of the year
    cells = cells.withColumn("_busy", F.col("_load") > cells.agg(usual).scalar())

    def late(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("_late"))) * F.lit(100.0) / F.nullif(F.sum(F.when(cond, F.col("_flags"))), F.lit(0))

    def share(cond: Column) -> Column:
        return F.avg(F.when(F.col("_first") & cond, F.col("_share"))) * F.lit(100.0)

    out, load, gust = F.col("direction") == departure, F.col("hour_load"), F.col("_wpgt")
    return cells.agg(
        late(out & (load > busy_load)).alias("late_pct_busy_hours"), late(out & (load <= quiet_load)).alias("late_pct_quiet_hours"),
        share(gust >= storm).alias("storm_day_late_pct"), share(gust < calm_day).alias("calm_day_late_pct"),
        late(F.col("_busy") & (gust >= storm)).alias("late_pct_busy_storm"), late(~F.col("_busy") & (gust < calm)).alias("late_pct_quiet_calm"),
        late(F.col("_frost")).alias("late_pct_frost"), late(~F.col("_frost")).alias("late_pct_no_frost"))


def report_round(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """The named columns rounded as report tables show them (halves to the even digit)."""
    return df.withColumns({c: X.round_half_even(c, d) for c, d in digits.items()})


def selection_text(df: DataFrame, year: int | None = None, direction: str | None = None, airlines: Sequence[str] = (), aircraft: Sequence[str] = (),
                   everything: str = "(all)") -> DataFrame:
    """The chosen filters and the number of rows they leave, as one text (one row)."""
    chosen = lambda values: ", ".join(values) if values else everything
    parts = [str(year) if year is not None else "all years", direction or "both directions", f"airline {chosen(airlines)}", f"type {chosen(aircraft)}"]
    n = apply_filters(df, direction, airlines, aircraft, year).agg(F.count(F.lit(1)).alias("_n"))
    return n.select(F.concat(F.lit(" · ".join(parts) + " · "), X.nl_number("_n", 0), F.lit(" flights")).alias("selection"))


def weather_classes(days: DataFrame, bins: dict[str, tuple[Sequence[float], Sequence[str]]], min_days: int = 3, day: str = "day") -> DataFrame:
    """A12 + C23: every variable of ``bins`` in classes (left-closed), split into busy and quiet days and unsplit.

    ``days``: one row per day with ``n``, ``n_late`` and the variables. The variables
    are stacked, joined to a table of all edges (as long as ``bins``) by range, and
    aggregated once for both groupings. A day is busy if its ``n`` is above the median
    of the days that have the variable; values outside the edges are in no class."""
    spark = days.sparkSession
    edges = spark.createDataFrame([(v, i + 1, float(lo), float(hi), label) for v, (e, labels) in bins.items()
                                   for i, (lo, hi, label) in enumerate(zip(e[:-1], e[1:], labels, strict=True))],
                                  "variable string, class_no int, _lo double, _hi double, weather_class string")
    long = days.select(day, "n", "n_late", *[F.col(v).cast("double").alias(v) for v in bins]).unpivot([day, "n", "n_late"], [*bins], "variable", "_value")
    long = long.filter(F.col("_value").isNotNull())
    usual = median_table(long, ["variable"], "n", "_median")
    inside = (F.col("_value") >= F.col("_lo")) & (F.col("_value") < F.col("_hi"))
    busy = F.when(F.col("n") > F.col("_median"), F.lit("busy day")).otherwise(F.lit("quiet day"))
    classed = (long.join(F.broadcast(usual), "variable").withColumn("day_type", busy)  # a row per variable
               .join(F.broadcast(edges), "variable").filter(inside))
    keys = ["variable", "class_no", "weather_class"]
    out = classed.groupingSets([[*keys, "day_type"], keys], *keys, "day_type").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_days"), (F.sum("n_late") * F.lit(100.0) / F.sum("n")).alias("late_pct"),
        F.grouping("day_type").alias("_all"))
    whole = F.when(F.col("_all") == 1, F.lit("all days")).otherwise(F.col("day_type"))
    return out.filter(F.col("n_days") >= min_days).select(*keys, whole.alias("day_type"), "n", "n_days", "late_pct")
