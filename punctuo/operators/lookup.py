"""Dimension lookups.

Dimensions (airports, daily weather) are small and bounded: each is
de-duplicated on its key (first row in an explicit order, so a join can never
multiply fact rows), its size is checked, and it is broadcast — the fact side
is never shuffled. Reports about codes work on the distinct codes with their
row counts, not on fact rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuo.config import DEFAULTS, Params
from punctuo.functions import columns as X
from punctuo.operators.util import fits_rows, materialize, sized_broadcast


def first_per_key(dim: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per non-NULL key — the first in ``order`` (file order stand-in)."""
    w = Window.partitionBy(key).orderBy(*[X.col(o).asc_nulls_last() for o in order])
    return (dim.filter(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(w))
               .filter(F.col("_rn") == 1).drop("_rn"))


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """The rows with a key, checked at run time: a key with a second row raises."""
    rows = F.count(F.lit(1)).over(Window.partitionBy(key))
    problem = F.concat(F.lit(f"more than one row for {key} "), F.col(key).cast("string"))
    kept = dim.filter(F.col(key).isNotNull()).withColumn("_rows", rows)
    return kept.filter(F.when(F.col("_rows") == 1, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))).drop("_rows")


def _side(dim: DataFrame, key: str, attrs: Sequence[str], order: Sequence[str], tag: str) -> DataFrame:
    d = first_per_key(dim, key, order)
    return d.select(F.col(key).alias(f"_{tag}_key"), *[F.col(a).alias(f"_{tag}_{a}") for a in attrs])


def lookup_two_keys(fact: DataFrame, dim: DataFrame, code: str, key_a: str, key_b: str, attrs: Sequence[str],
                    order: Sequence[str], found: str, params: Params = DEFAULTS) -> DataFrame:
    """Left lookup on the first key, then the second; the result is the
    cell-wise coalesce (every NULL cell of the first match is filled from the
    second, like ``combine_first``). ``matched_by`` = key_a / key_b / NULL,
    decided by ``found`` (e.g. the name) being present, as the match counters do."""
    # one bounded count on a pruned projection (no derived columns computed);
    # both sides are subsets of dim, so one proof covers both broadcasts
    small = fits_rows(dim.select(F.lit(1).alias("_one")), params.broadcast_max_rows)
    if not small:
        return _lookup_via_codes(fact, dim, code, key_a, key_b, attrs, order, found, params)
    dim = materialize(dim)  # proven small: compute it once for both sides
    a = F.broadcast(_side(dim, key_a, attrs, order, "a"))
    b = F.broadcast(_side(dim, key_b, attrs, order, "b"))
    j = fact.join(a, fact[code] == a["_a_key"], "left").join(b, fact[code] == b["_b_key"], "left")
    matched = (F.when(F.col(f"_a_{found}").isNotNull(), F.lit("key_a"))
                .when(F.col(f"_b_{found}").isNotNull(), F.lit("key_b")))
    return j.select(*[fact[c] for c in fact.columns],
                    *[F.coalesce(F.col(f"_a_{x}"), F.col(f"_b_{x}")).alias(x) for x in attrs],
                    matched.alias("matched_by"),
                    F.col("_a_key").isNotNull().alias("_code_in_a"),
                    F.col("_b_key").isNotNull().alias("_code_in_b"))


def _lookup_via_codes(fact: DataFrame, dim: DataFrame, code: str, key_a: str, key_b: str, attrs: Sequence[str],
                      order: Sequence[str], found: str, params: Params) -> DataFrame:
    """Large-dimension path: resolve the fact's DISTINCT codes against the
    dimension (shuffle joins of two small-to-medium tables), then join the
    fact once with that code map — broadcast when its size is proven, else a
    single salted shuffle join (instead of two shuffles of the whole fact)."""
    codes = fact.select(F.col(code).alias("_code")).filter(F.col("_code").isNotNull()).distinct()
    a = _side(dim, key_a, attrs, order, "a")
    b = _side(dim, key_b, attrs, order, "b")
    m = codes.join(a, codes["_code"] == a["_a_key"], "left").join(b, codes["_code"] == b["_b_key"], "left")
    resolved = materialize(m.select(
        "_code", *[F.coalesce(F.col(f"_a_{x}"), F.col(f"_b_{x}")).alias(f"_r_{x}") for x in attrs],
        (F.when(F.col(f"_a_{found}").isNotNull(), F.lit("key_a"))
          .when(F.col(f"_b_{found}").isNotNull(), F.lit("key_b"))).alias("_r_matched"),
        F.col("_a_key").isNotNull().alias("_r_in_a"), F.col("_b_key").isNotNull().alias("_r_in_b")))
    if fits_rows(resolved, params.broadcast_max_rows):
        j = fact.join(F.broadcast(resolved), fact[code] == resolved["_code"], "left")
    else:
        j = salted_left_join(fact, resolved, code, "_code")
    return j.select(*[fact[c] for c in fact.columns], *[F.col(f"_r_{x}").alias(x) for x in attrs],
                    F.col("_r_matched").alias("matched_by"),
                    F.coalesce(F.col("_r_in_a"), F.lit(False)).alias("_code_in_a"),
                    F.coalesce(F.col("_r_in_b"), F.lit(False)).alias("_code_in_b"))


def salted_left_join(fact: DataFrame, dim: DataFrame, code: str, key: str, share: int = 1024) -> DataFrame:
    """``fact`` left join ``dim`` (one row per ``key``) by a shuffle that no code can make uneven.

    A code is hot from a ``share``-th of all rows on, so at most ``share`` codes are: that
    table is broadcast whatever the data. A hot code's rows are dealt over ``share`` salts by
    the hash of the row and its dimension row is repeated for each; rows without a code
    are dealt alike and meet no dimension row. Every other code keeps salt 0. Equal rows
    share a salt, so ``fact`` should be free of exact duplicates, as the cleaned one is."""
    total = fact.select(F.count(F.lit(1))).scalar()
    hot = F.broadcast(code_counts(fact, code).filter(F.col(code).isNotNull() & (F.col("n") * F.lit(share) >= total)).select(F.col(code).alias("_hot")))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(share)).cast("int")
    marked = fact.join(hot, F.col(f"`{code}`") == F.col("_hot"), "left")
    dealt = marked.withColumn("_salt", F.when(F.col("_hot").isNotNull() | F.col(f"`{code}`").isNull(), salt).otherwise(F.lit(0)))
    salts = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(share - 1))).otherwise(F.array(F.lit(0)))
    copies = dim.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_dim_salt", F.explode(salts)).drop("_hot")
    return dealt.join(copies, (F.col(f"`{code}`") == F.col(key)) & (F.col("_salt") == F.col("_dim_salt")), "left").drop("_hot", "_salt", "_dim_salt")


def code_counts(fact: DataFrame, code: str) -> DataFrame:
    """Distinct codes with their row counts (NULL code kept as one row)."""
    return fact.groupBy(code).agg(F.count(F.lit(1)).alias("n"))


def lookup_report(fact: DataFrame, dim: DataFrame, code: str, key_a: str, key_b: str, attrs: Sequence[str],
                  order: Sequence[str], found: str, params: Params = DEFAULTS) -> DataFrame:
    """A22 + J9: distinct codes, codes present per key, rows per outcome (one row).

    Computed on the code-frequency table, so the fact is aggregated once and
    the lookup runs on distinct codes only."""
    codes = code_counts(fact, code)
    look = lookup_two_keys(codes, dim, code, key_a, key_b, attrs, order, found, params)
    has_code = F.col(code).isNotNull()
    m = F.col("matched_by")
    return look.agg(
        F.count_if(has_code).alias("n_codes"),
        F.count_if(has_code & F.col("_code_in_a")).alias("codes_in_key_a"),
        F.count_if(has_code & F.col("_code_in_b")).alias("codes_in_key_b"),
        F.coalesce(F.sum(F.when(m == "key_a", F.col("n"))), F.lit(0)).alias("rows_via_key_a"),
        F.coalesce(F.sum(F.when(m == "key_b", F.col("n"))), F.lit(0)).alias("rows_via_key_b"),
        F.coalesce(F.sum(F.when(~has_code, F.col("n"))), F.lit(0)).alias("rows_without_code"),
        F.coalesce(F.sum(F.when(has_code & m.isNull(), F.col("n"))), F.lit(0)).alias("rows_code_unknown"),
    )


def unmatched_codes(fact: DataFrame, dim: DataFrame, code: str, key_a: str, key_b: str, found: str,
                    order: Sequence[str], params: Params = DEFAULTS) -> DataFrame:
    """Codes that no key resolves (by ``found`` being NULL), with row counts."""
    codes = code_counts(fact, code).filter(F.col(code).isNotNull())
    look = lookup_two_keys(codes, dim, code, key_a, key_b, [found], order, found, params)
    return look.filter(F.col("matched_by").isNull()).select(code, "n")


def unmatched_text(unmatched: DataFrame, code: str) -> DataFrame:
    """C39: 'CODE (n×), …' as one text (sorted; bounded by the unknown codes)."""
    return unmatched.agg(F.array_join(F.sort_array(F.collect_list(
        F.concat(F.col(code), F.lit(" ("), F.col("n").cast("string"), F.lit("×)")))), ", ").alias("unknown_codes"))


def key_multiplicity(dim: DataFrame, key: str) -> DataFrame:
    """J4 check: the largest number of dimension rows sharing one key value."""
    return dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.coalesce(F.max("_c"), F.lit(0)).alias(f"max_rows_per_{key}"))


def home_coordinates(dim: DataFrame, is_home, order, lat: str = "lat", lon: str = "lon"):
    """The home place's coordinates (first home row in ``order``) as one
    scalar subquery (no join)."""
    home = dim.filter(is_home).select(
        F.min_by(F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")), X.col(order))).scalar()
    return home.getField("lat"), home.getField("lon")


def with_distance(dim: DataFrame, is_home, order, lat: str = "lat", lon: str = "lon",
                  params: Params = DEFAULTS) -> DataFrame:
    """C18 + C19 on the dimension: distance from home and the area class.

    Computed per place, not per flight: the lookup then carries the result."""
    h_lat, h_lon = home_coordinates(dim, is_home, order, lat, lon)
    dist = X.haversine_km(h_lat, h_lon, F.col(lat), F.col(lon), params.earth_radius_km)
    return (dim.withColumn("distance_km", dist)
               .withColumn("area", X.distance_class("distance_km", params.long_haul_km)))


def attach_daily(fact: DataFrame, daily: DataFrame, day: str = "day", params: Params = DEFAULTS) -> DataFrame:
    """J5 + C20: each row gets its day's conditions (left join, checked broadcast
    of the one-row-per-day table) and the frost flag. A day with two rows is an
    error in the daily table: the query fails instead of taking either row."""
    d = sized_broadcast(materialize(one_per_key(daily, day)), params.broadcast_max_rows)
    cols = [c for c in d.columns if c != day]
    out = fact.join(d, day, "left").select(*fact.columns, *cols)
    return out.withColumn("frost", X.frost_flag("tmin")) if "tmin" in cols else out
