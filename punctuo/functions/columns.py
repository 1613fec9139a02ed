"""Column expressions: cleaning, time, calendar, codes, geo, bins, formatting.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so they
stay inside whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuo import config as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Trimming, missing markers, lenient numbers
# --------------------------------------------------------------------------
def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column (other columns untouched, order kept)."""
    return df.select(*[
        F.trim(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def null_if_token(c, tokens: Sequence[str]) -> Column:
    """A missing marker (``-``, ``#N/A``, empty, ``\\N``) becomes SQL NULL."""
    c = col(c)
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def null_tokens(df: DataFrame, tokens: Sequence[str] = C.FLIGHT_NULL_TOKENS) -> DataFrame:
    """C2 over all string columns."""
    return df.select(*[
        null_if_token(F.col(f"`{f.name}`"), tokens).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def lenient_double(c) -> Column:
    """``to_numeric(errors='coerce')`` — unparsable text becomes NULL."""
    return col(c).try_cast("double")


# --------------------------------------------------------------------------
# Strict date/time parsing, midnight rollover, delay, late flag
# --------------------------------------------------------------------------
def parse_day(c, fmt: str = "dd/MM/yyyy") -> Column:
    """Strict date parse (ANSI mode raises on a malformed value)."""
    return F.to_date(col(c), fmt)


def day_time(day_text, time_text, fmt: str = "dd/MM/yyyy HH:mm:ss") -> Column:
    """Date text + ``HH:mm:ss`` text → local timestamp without zone.

    A missing time gives a missing timestamp (``concat`` is NULL-propagating)."""
    return F.to_timestamp_ntz(F.concat(col(day_text), F.lit(" "), col(time_text)), F.lit(fmt))


def minutes_between(start, end) -> Column:
    """(end − start) in minutes, exact to the microsecond."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(60_000_000.0)


def rollover_flag(planned, actual, limit_min: float = C.ROLLOVER_MIN) -> Column:
    """Actual lies more than 12 h before planned; missing → False."""
    return F.coalesce(minutes_between(planned, actual) < F.lit(limit_min), F.lit(False))


def early_rollover_flag(planned, actual, limit_min: float = C.ROLLOVER_MIN) -> Column:
    """Symmetric mode: actual lies more than 12 h after planned (early across midnight)."""
    return F.coalesce(minutes_between(planned, actual) > F.lit(-limit_min), F.lit(False))


def add_days(c, n: int) -> Column:
    return F.timestamp_add("DAY", F.lit(n), col(c))


def late_flag(delay, threshold: float = C.LATE_MIN) -> Column:
    """Delay ≥ threshold; missing (or NaN) → False, never NULL."""
    d = col(delay)
    return F.coalesce(F.when(F.isnan(d), F.lit(False)).otherwise(d >= F.lit(threshold)), F.lit(False))


# --------------------------------------------------------------------------
# Calendar parts, code maps, ordinal names, airline prefix
# --------------------------------------------------------------------------
def calendar_columns(ts, day=None) -> dict[str, Column]:
    """Date, year, month, weekday (Monday = 0), hour of a timestamp."""
    ts = col(ts)
    d = F.to_date(ts) if day is None else col(day)
    return {
        "day": d,
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "weekday": F.weekday(d).cast("int"),
        "hour": F.hour(ts).cast("int"),
    }


def map_codes(c, mapping: dict, default=None) -> Column:
    """Code → label; unknown codes give ``default`` (a value, a Column or NULL)."""
    c = col(c)
    expr = reduce(lambda acc, kv: acc.when(c == F.lit(kv[0]), F.lit(kv[1])),
                  list(mapping.items())[1:],
                  F.when(c == F.lit(next(iter(mapping))), F.lit(mapping[next(iter(mapping))])))
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def ordinal_name(c, names: Sequence[str], base: int = 0) -> Column:
    """Ordinal → name (weekday 0 = Monday, month 1 = January)."""
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), col(c) - F.lit(base - 1))


def airline_prefix(flight_no) -> Column:
    """C14: third character a (Unicode) letter → 3-character code, else 2."""
    c = col(flight_no)
    return F.when(c.rlike(r"^..\p{L}"), F.substring(c, 1, 3)).otherwise(F.substring(c, 1, 2))


# --------------------------------------------------------------------------
# Periods, geo, classes, clip, arithmetic
# --------------------------------------------------------------------------
def null_from(c, day, start: str) -> Column:
    """NULL the measure from ``start`` on (a known-bad period)."""
    return F.when(col(day) >= F.to_date(F.lit(start)), F.lit(None).cast("double")).otherwise(col(c))


def haversine_km(lat1, lon1, lat2, lon2, radius: float = C.EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km (built-in math functions, no UDF)."""
    la1, lo1, la2, lo2 = (F.radians(col(x)) for x in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(a))


def distance_class(dist, long_haul_km: float = C.LONG_HAUL_KM,
                   far: str = "intercontinental", near: str = "europe and around") -> Column:
    """≥ long-haul → far, else near; missing distance stays missing."""
    d = col(dist)
    return F.when(d.isNull() | F.isnan(d), F.lit(None).cast("string")).when(d >= long_haul_km, F.lit(far)).otherwise(F.lit(near))


def frost_flag(tmin) -> Column:
    """C20: tmin < 0, missing → False."""
    return F.coalesce(col(tmin) < F.lit(0.0), F.lit(False))


def clip(c, lo: float, hi: float) -> Column:
    """Limit to [lo, hi]. NULL stays NULL (Spark's greatest/least skip
    NULL arguments, so the guard is needed)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def pct(share) -> Column:
    """Share → percentage."""
    return col(share) * F.lit(100.0)


def pct_change(base, new) -> Column:
    """(new − base) / base × 100; NULL when base is 0 or missing."""
    b = col(base).cast("double")
    return F.try_divide(col(new).cast("double") - b, b) * F.lit(100.0)


def ratio_pct(base, new) -> Column:
    """New / base × 100; NULL when base is 0."""
    return F.try_divide(col(new).cast("double"), col(base).cast("double")) * F.lit(100.0)


# --------------------------------------------------------------------------
# bins
# --------------------------------------------------------------------------
def bin_number(c, edges: Sequence[float], closed: str = "right") -> Column:
    """1-based bin of fixed edges; out of range (or NULL) → NULL.

    ``closed='right'``: (a, b] (``pd.cut`` default); ``closed='left'``: [a, b)."""
    c = col(c)
    conds = []
    for i in range(1, len(edges)):
        lo, hi = F.lit(float(edges[i - 1])), F.lit(float(edges[i]))
        inside = (c > lo) & (c <= hi) if closed == "right" else (c >= lo) & (c < hi)
        conds.append((inside, i))
    expr = F.when(conds[0][0], F.lit(conds[0][1]))
    for cond, i in conds[1:]:
        expr = expr.when(cond, F.lit(i))
    return expr


def bin_label(c, edges: Sequence[float], labels: Sequence[str] | None = None, closed: str = "right") -> Column:
    """Label of ``bin_number`` (generated from the edges when no labels are given)."""
    labels = list(labels) if labels else edge_labels(edges, closed)
    return ordinal_name(bin_number(c, edges, closed), labels, base=1)


def edge_labels(edges: Sequence[float], closed: str = "right") -> list[str]:
    fmt = lambda x: f"{x:g}"
    if closed == "right":
        return [f"({fmt(a)}, {fmt(b)}]" for a, b in zip(edges[:-1], edges[1:])]
    return [f"[{fmt(a)}, {fmt(b)})" for a, b in zip(edges[:-1], edges[1:])]


def quantile_bin(c, edges_col) -> Column:
    """Equal-frequency bin given sorted distinct quantile edges (an array column).

    Right-closed, lowest value included, ties stay together; fewer than two
    distinct edges → no bin (pandas keeps no interval)."""
    c = col(c)
    n_below = F.size(F.filter(edges_col, lambda e: e < c))
    inside = (c >= F.element_at(edges_col, 1)) & (c <= F.element_at(edges_col, -1)) & (F.size(edges_col) >= 2)
    return F.when(inside, F.greatest(n_below, F.lit(1)))


def histogram_bin(c, lo: float = C.HIST_LO, hi: float = C.HIST_HI, width: float = C.HIST_WIDTH) -> Column:
    """A24 key: clip first, then fixed-width bin number (0-based); NULL ignored."""
    return F.floor((clip(c, lo, hi) - F.lit(lo)) / F.lit(width)).cast("int")


# --------------------------------------------------------------------------
# presentation
# --------------------------------------------------------------------------
def nl_number(c, decimals: int = 0) -> Column:
    """Local number format 323.461 / 8,3; missing → '–'."""
    return F.coalesce(F.translate(F.format_number(col(c), decimals), ",.", ".,"), F.lit("–"))


def round_half_even(c, digits: int) -> Column:
    """Rounding of report tables, halves to the even digit."""
    return F.rint(col(c) * F.lit(10.0 ** digits)) / F.lit(10.0 ** digits)


def date_label(c, fmt: str = "dd-MM-yyyy") -> Column:
    """Date as text."""
    return F.date_format(col(c), fmt)


def label_concat(*cols, sep: str = " · ") -> Column:
    """C33: 'City · Name'."""
    return F.concat_ws(sep, *[col(c) for c in cols])


def list_text(values: Iterable) -> Column:
    """Distinct values joined into one sorted text (use inside ``agg``)."""
    return F.array_join(F.sort_array(F.collect_set(col(values))), ", ")
