"""Readers by name, strict weather values, one row per day, samples of any size, bounded broadcasts."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from punctuo.operators import evaluate as EV
from punctuo.operators import lookup as LK
from punctuo.operators import reports as RP
from punctuo.operators import util
from punctuo.sources import files as SF

WEATHER = "date,tavg,tmin,tmax,prcp,snow,tsun,wspd,wpgt,pres"


def csv(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_flight_columns_are_bound_by_name(spark, tmp_path):
    p = csv(tmp_path / "f.csv", "FLT,Extra,Identifier", "KL1,x,7", "KL2,,8")
    rows = SF.read_flights_csv(spark, p, ["Identifier", "FLT"]).collect()
    assert [tuple(r) for r in rows] == [("7", "KL1", "x"), ("8", "KL2", "")]
    with pytest.raises(ValueError, match="missing"):
        SF.read_flights_csv(spark, p, ["Identifier", "RWY"])


def test_weather_is_bound_by_name_and_strict(spark, tmp_path):
    names = WEATHER.split(",")
    turned = [*names[:7], "wpgt", "wspd", "pres", "station"]
    p = csv(tmp_path / "w.csv", ",".join(turned), "2020-01-01,1,2,3,4,,,44,11,1000,EDDF")
    r = SF.read_weather(spark, p).collect()[0]
    assert (r.date, r.wpgt, r.wspd, r.snow, r.station) == (dt.date(2020, 1, 1), 44.0, 11.0, None, "EDDF")
    with pytest.raises(ValueError, match="pres"):
        SF.read_weather(spark, csv(tmp_path / "m.csv", ",".join(names[:-1]), "2020-01-01,1,2,3,4,,,5,6"))
    bad = SF.read_weather(spark, csv(tmp_path / "b.csv", WEATHER, "2020-01-01,1,2,3,4,,,5,6,many"))
    with pytest.raises(Exception, match="column pres"):
        bad.collect()


def test_a_day_with_two_rows_is_an_error(spark):
    fact = spark.createDataFrame([(dt.date(2020, 1, 1),)], "day date")
    daily = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 1, 1), 2.0)], "day date, tmin double")
    with pytest.raises(Exception, match="more than one row for day"):
        LK.attach_daily(fact, daily).collect()
    assert LK.attach_daily(fact, daily.filter("tmin = 1")).collect()[0].tmin == 1.0


@pytest.mark.parametrize("n", [99, 100, 101, 200, 300, 301, 5000])
def test_hash_sample_of_any_size(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = sorted(r.k for r in EV.hash_sample(df, "k", 100, 42).collect())
    want = sorted(r.k for r in df.orderBy(F.xxhash64("k", F.lit(42)), "k").limit(100).collect())
    assert got == want


def test_broadcast_proof_counts_bytes(spark, monkeypatch):
    df = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert util.fits_rows(df, 10) and not util.fits_rows(df, 9)
    monkeypatch.setattr(util, "MAX_BROADCAST_BYTES", 5000)
    assert not util.fits_rows(df, 10)


@pytest.mark.parametrize("reader", ["flights", "weather"])
def test_folder_of_two_header_orders(spark, tmp_path, reader):
    """Read right by each file's own header, or an error that names the file; never by the first file's order."""
    if reader == "flights":
        heads, rows = ["Identifier,FLT", "FLT,Identifier"], ["3,KL3", "KL4,4"]
        read = lambda how: SF.read_flights(spark, str(tmp_path), ["Identifier", "FLT"], headers=how)
        want = [("3", "KL3"), ("4", "KL4")]
    else:
        names = WEATHER.split(",")
        heads, rows = [WEATHER, ",".join([*names[:7], "wpgt", "wspd", "pres"])], ["2020-01-01,1,2,3,4,,,11,44,1000", "2020-01-02,1,2,3,4,,,45,12,1000"]
        read = lambda how: SF.read_weather(spark, str(tmp_path), headers=how).select(F.dayofmonth("date"), "wspd", "wpgt")
        want = [(1, 11.0, 44.0), (2, 12.0, 45.0)]
    csv(tmp_path / "a.csv", "\ufeff" + heads[0], rows[0])
    csv(tmp_path / "b.csv", heads[1], rows[1])
    assert sorted(map(tuple, read("each").collect())) == want
    with pytest.raises(Exception, match="(?s)header.*b.csv|CSV header"):
        read("same").collect()


def test_folder_with_a_missing_or_further_column(spark, tmp_path):
    csv(tmp_path / "a.csv", "Identifier,FLT", "3,KL3")
    csv(tmp_path / "b.csv", "FLT,Identifier,RWY", "KL4,4,28")
    with pytest.raises(ValueError, match="RWY"):
        SF.read_flights(spark, str(tmp_path), ["Identifier", "FLT"], headers="each")
    with pytest.raises(ValueError, match="missing"):
        SF.read_flights(spark, str(tmp_path), ["Identifier", "RWY"], headers="each")
    with pytest.raises(Exception, match="(?i)header|columns"):
        SF.read_flights(spark, str(tmp_path), ["Identifier", "FLT"]).collect()


def test_a_group_with_most_values_is_spread(spark):
    """No step has a group's values in one place: the largest range of a hot group holds a small share of its values."""
    from punctuo.operators import quantiles as QT

    n = 200_000
    df = spark.range(n, numPartitions=8).select(F.when(F.col("id") % 10 == 0, F.concat(F.lit("g"), F.col("id") % 7)).otherwise("hot").alias("k"), (F.rand(3) * 240 - 60).alias("v"))
    got = {r.k: r["median"] for r in QT.median_table(df, ["k"], "v").collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    most = df.filter("k = 'hot'").groupBy(QT.value_range(F.col("v"))).count().agg(F.max("count")).first()[0]
    assert most < 0.002 * n
    plan = QT.median_table(df, ["k"], "v")._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"windowspecdefinition\(([^)]*?) ASC", plan)
    assert windows and all("_r#" in w for w in windows)


@pytest.mark.parametrize("values", [[0.3 + i * 1e-9 for i in range(4000)], [0.5] * 50, [i / 7 for i in range(300)], []])
def test_auc_of_near_and_equal_scores(spark, values):
    import random

    rng = random.Random(1)
    rows = [(v, rng.random() < 0.4) for v in values] + [(None, True), (0.4, None)]
    df = spark.createDataFrame(rows, "p_late double, is_late boolean")
    pos, neg = ([v for v, y in rows if v is not None and y is want] for want in (True, False))
    r = EV.auc(df, per_range=16).first().auc if pos and neg else None
    if r is not None:
        import numpy as np

        order = np.searchsorted(np.sort(neg), pos, "left") + np.searchsorted(np.sort(neg), pos, "right")
        assert abs(r - order.sum() / 2 / len(pos) / len(neg)) < 1e-12
    d = df.filter("p_late is not null").groupBy("p_late").count()
    edges = EV.score_ranges(d, "p_late", 16)
    sizes = [x[1] for x in d.groupBy(F.size(F.filter(edges, lambda e: e < F.col("p_late")))).count().collect()]
    assert max(sizes, default=0) <= 3 * 16


def test_confusion_bins(spark):
    rows = [(0.1, True), (0.1, False), (0.15, True), (0.8, False), (0.95, True), (0.0, False), (None, True), (0.5, None)]
    df = spark.createDataFrame(rows, "p_late double, is_late boolean")
    ts = EV.thresholds()
    got = {round(r.threshold, 2): (r.tp, r.fp, r.fn, r.tn) for r in EV.confusion_sweep(df).collect()}
    for t in ts:
        cell = lambda warn, late: sum(1 for s, y in rows if s is not None and y is late and (s >= t) is warn)
        assert got[t] == (cell(True, True), cell(True, False), cell(False, True), cell(False, False))
    plan = EV.confusion_sweep(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") == 1 and "Join" not in plan
    assert EV.confusion_sweep(df.filter("false")).collect() == []


def test_row_numbers_and_permuted_columns(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("x"), (F.col("id") % 5).alias("y"), (F.col("id") % 7 > 3).alias("is_late"))
    h = EV._seeded("k", "a")
    got = {r.k: r.n for r in EV.row_numbers(df, h, "k", "n").collect()}
    want = [r.k for r in df.orderBy(h, "k").collect()]
    assert sorted(got, key=got.get) == want and sorted(got.values()) == [*range(1, 3001)]
    imp = {r.feature: r.auc_drop for r in EV.permuted_auc_drop(df, ["x", "y"], lambda d: d.withColumn("p_late", F.col("x") / 7 + F.col("y") * 0), "k").collect()}
    assert 0.4 < imp["x"] < 0.6 and imp["y"] == 0


def test_year_delta_needs_both_years_and_enough_rows(spark):
    rows = [(2019, "A", 10.0, False)] * 30 + [(2020, "B", 20.0, True)] * 29 + [(2020, None, None, False)] + [(2018, "C", 0.0, False)] * 100
    df = spark.createDataFrame(rows, "year int, place_code string, delay_min double, is_late boolean")
    got = {r.measure: (r.value_a, r.value_b, r.delta) for r in RP.year_delta(df, 2019, 2020).collect()}
    assert got["n"] == (30, 30, 0) and got["median_delay"] == (10, 20, 10) and got["n_places"] == (1, 1, 0)
    assert abs(got["late_pct"][2] - 100 * 29 / 30) < 1e-9 and got["avg_delay"] == (10, 20, 10)
    assert RP.year_delta(df, 2019, 2021).collect() == [] and RP.year_delta(df, 2019, 2020, min_rows=61).collect() == []
    assert RP.year_delta(df.filter("false"), 2019, 2020).collect() == []
