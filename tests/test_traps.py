"""Literal frames for the semantic traps (FIXTURES.md §C, SURVEY §1.5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F


from punctuo.functions import columns as X
from punctuo.operators import clean as CL
from punctuo.operators import evaluate as EV
from punctuo.operators import features as FE
from punctuo.operators import lookup as LK
from punctuo.operators import reports as RP


def fact(spark, rows, schema="k string, delay_min double"):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("is_late", X.late_flag("delay_min"))


def test_null_key_is_dropped(spark):
    out = RP.summary(fact(spark, [("x", 1.0), (None, 2.0)]), "k").collect()
    assert [r.k for r in out] == ["x"]


def test_missing_actual_counts_in_n_not_in_mean(spark):
    r = RP.summary(fact(spark, [("x", None), ("x", 20.0)]), "k").first()
    assert (r.n, r.late_pct, r.avg_delay, r.median_delay) == (2, 50.0, 20.0, 20.0)


def test_nan_is_not_late(spark):
    r = spark.createDataFrame([(float("nan"),)], "d double").select(X.late_flag("d").alias("x")).first()
    assert r.x is False


RAW_COLS = ["Identifier", "STD", "STA_STD_ltc", "ATA_ATD_ltc", "FLT", "LSV"]


def raw(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in RAW_COLS))


def test_rollover(spark):
    rows = [("1", "01/01/2019", "22:45:00", "00:05:00", "EZY1", "S"),
            ("2", "01/01/2019", "00:05:00", "23:50:00", "LX1", "L"),
            ("3", "01/01/2019", "10:00:00", "09:50:00", "A3850", "S"),
            ("4", "01/01/2019", "12:00:00", "00:00:00", "LX2", "S")]
    out = {r.Identifier: r for r in CL.clean_flights(raw(spark, rows)).collect()}
    assert out["1"].delay_min == 80 and out["1"].rolled_over
    assert out["2"].delay_min == 1425 and not out["2"].rolled_over   # early across midnight: not repaired
    assert out["3"].delay_min == -10 and not out["3"].rolled_over
    assert out["4"].delay_min == -720 and not out["4"].rolled_over   # strict limit
    assert out["1"].actual_ts == dt.datetime(2019, 1, 2, 0, 5)


def test_symmetric_rollover_option(spark):
    from punctuo.config import DEFAULTS
    rows = [("2", "01/01/2019", "00:05:00", "23:50:00", "LX1", "L")]
    r = CL.clean_flights(raw(spark, rows), DEFAULTS.with_(symmetric_rollover=True)).first()
    assert r.delay_min == -15


def test_trim_sentinels_prefix_direction(spark):
    rows = [(" 9 ", "07/01/2019", "10:00:00", "-", " EZY2191 ", "X"),
            ("10", "07/01/2019", "10:00:00", "#N/A", "LX092", "S"),
            ("11", "07/01/2019", "10:00:00", "10:20:00", "A3850", "L")]
    out = {r.Identifier: r for r in CL.clean_flights(raw(spark, rows)).collect()}
    assert out["9"].flight_no == "EZY2191" and out["9"].airline == "EZY" and out["9"].direction is None
    assert out["9"].delay_min is None and out["9"].is_late is False
    assert out["10"].airline == "LX" and out["10"].direction == "departure"
    assert out["11"].airline == "A3" and out["11"].direction == "arrival" and out["11"].is_late is True
    assert out["11"].weekday == 0 and out["11"].hour == 10


def test_strict_date_parse_raises(spark):
    rows = [("1", "2019-01-07", "10:00:00", "10:00:00", "LX1", "S")]
    with pytest.raises(Exception):
        CL.clean_flights(raw(spark, rows)).collect()


def test_clean_metrics_counts_duplicates(spark):
    rows = [("1", "01/01/2019", "22:45:00", "00:05:00", "EZY1", "S")] * 3 + \
           [("1", "01/01/2019", "22:45:00", "00:06:00", "EZY1", "S"), ("2", "01/01/2019", "10:00:00", "10:00:00", "LX1", "S")]
    r = CL.clean_metrics(raw(spark, rows)).first()
    assert (r.raw_rows, r.duplicate_rows, r.duplicate_ids, r.rollovers) == (5, 2, 1, 2)


PLACE = "place_id int, name string, city string, key_a string, key_b string"


def test_two_key_lookup_cellwise_and_priority(spark):
    dim = spark.createDataFrame([
        (1, "Alpha", None, "AAAA", "AAA"),      # A-match with NULL city
        (2, "Alpha2", "Acity", "ZZZZ", "AAAA"),  # B-match on the same code, with city
        (3, "Beta", "Bcity", "BBBB", "BBB"),
        (4, "Beta-dup", "X", "BBBB", "B2"),     # duplicate key_a: lowest id wins
    ], PLACE)
    f = spark.createDataFrame([("AAAA",), ("BBB",), ("BBBB",), ("QQQ",), (None,)], "code string")
    out = {r.code: r for r in LK.lookup_two_keys(f, dim, "code", "key_a", "key_b", ["name", "city"], ["place_id"], "name").collect()}
    assert out["AAAA"].name == "Alpha" and out["AAAA"].city == "Acity" and out["AAAA"].matched_by == "key_a"
    assert out["BBB"].name == "Beta" and out["BBB"].matched_by == "key_b"
    assert out["BBBB"].name == "Beta"
    assert out["QQQ"].name is None and out["QQQ"].matched_by is None
    assert out[None].name is None
    assert len(out) == 5


def test_previous_hour_is_same_day_hour_minus_one(spark):
    df = spark.createDataFrame([
        (dt.date(2019, 1, 1), 0, 10.0), (dt.date(2019, 1, 1), 1, 20.0), (dt.date(2019, 1, 1), 3, 30.0),
        (dt.date(2019, 1, 2), 0, 40.0)], "day date, hour int, delay_min double")
    out = {(r.day.day, r.hour): r.prev_hour_delay for r in FE.add_load_features(df).collect()}
    assert out == {(1, 0): None, (1, 1): 10.0, (1, 3): None, (2, 0): None}


def test_load_features_counts(spark):
    df = spark.createDataFrame([(dt.date(2019, 1, 1), 5, None), (dt.date(2019, 1, 1), 5, 1.0),
                                (dt.date(2019, 1, 1), 6, 2.0)], "day date, hour int, delay_min double")
    out = sorted((r.hour, r.hour_load, r.day_load) for r in FE.add_load_features(df).collect())
    assert out == [(5, 2, 3), (5, 2, 3), (6, 1, 3)]


def test_right_closed_bins(spark):
    edges = (0, 20, 30, 40, 50, 60, 100)
    df = spark.createDataFrame([(v,) for v in (0, 1, 20, 21, 100, 101)], "v int")
    got = [r.b for r in df.select(X.bin_number("v", edges, "right").alias("b")).collect()]
    assert got == [None, 1, 1, 2, 6, None]


def test_left_closed_bins(spark):
    df = spark.createDataFrame([(v,) for v in (-21.0, -20.0, 0.0, 40.0)], "v double")
    got = [r.b for r in df.select(X.bin_number("v", (-20, 0, 40), "left").alias("b")).collect()]
    assert got == [None, 1, 2, None]


def test_quantile_bins_ties_and_all_equal(spark):
    df = spark.createDataFrame([(float(v), v % 2 == 0) for v in [1] * 50 + [2] * 30 + [3] * 20], "p_late double, is_late boolean")
    cal = {r.bin: r.n for r in EV.calibration(df, 10).collect()}
    assert sum(cal.values()) == 100 and cal[1] == 50          # ties stay together
    same = spark.createDataFrame([(0.5, True)] * 10, "p_late double, is_late boolean")
    assert EV.calibration(same, 10).count() == 0


def test_histogram_clips_first(spark):
    df = spark.createDataFrame([(v,) for v in (None, -60.0, 119.9, 500.0, -200.0)], "delay_min double")
    got = {r.bin_lo: r.n for r in RP.histogram(df).collect() if r.n}
    assert got == {-60.0: 2, 115.0: 2}
    assert RP.histogram(df).count() == 36


def _timeline_rows(spark, n):
    rows = [(dt.date(2019, 1, 1) + dt.timedelta(days=i), "departure", float(i), i % 2 == 0) for i in range(n)]
    return spark.createDataFrame(rows, "day date, direction string, delay_min double, is_late boolean")


def test_rolling_mean_min_periods(spark):
    out = RP.timeline(_timeline_rows(spark, 3), "day", None, rolling=7).collect()
    assert all(r.avg_delay_roll is None for r in out)
    out = RP.timeline(_timeline_rows(spark, 4), "day", None, rolling=7).collect()
    assert all(r.avg_delay_roll == 1.5 for r in out)


def test_week_bucket_monday(spark):
    df = spark.createDataFrame([(dt.date(2019, 1, 6), "d", 1.0, True), (dt.date(2019, 1, 7), "d", 1.0, True)],
                               "day date, direction string, delay_min double, is_late boolean")
    got = sorted(r.bucket for r in RP.timeline(df, "week", None).collect())
    assert got == [dt.date(2018, 12, 31), dt.date(2019, 1, 7)]


def test_confusion_zero_guard(spark):
    df = spark.createDataFrame([(0.05, True), (0.02, False)], "p_late double, is_late boolean")
    r = EV.confusion_sweep(df, [0.5]).first()
    assert (r.tp, r.fp, r.fn, r.tn, r.precision, r.recall, r.accuracy) == (0, 0, 1, 1, 0.0, 0.0, 0.5)


def test_category_cap(spark):
    rows = [(f"c{i:02d}",) for i in range(61) for _ in range(61 - i)] + [(None,)]
    df = spark.createDataFrame(rows, "aircraft string")
    top = FE.top_categories(df, ["aircraft"], 60)
    out = FE.encode_other(df, top, ["aircraft"])
    assert out.filter(F.col("aircraft") == "other").count() == 2   # the 61st category (1 row) and NULL
    assert top.count() == 60


def test_base_year_zero(spark):
    rows = [("P", 2000, 1.0, False)] * 3 + [("Q", 1999, 1.0, False), ("Q", 2000, 1.0, False)]
    df = spark.createDataFrame(rows, "place_code string, year int, delay_min double, is_late boolean")
    out = {r.place_code: r for r in RP.place_change(df, 1999, 2000, min_base=0).collect()}
    assert out["P"].n_a == 0 and out["P"].change_pct is None and out["Q"].change_pct == 0.0
    assert RP.place_change(df, 1999, 2000, min_base=1).count() == 1


def test_haversine_known_distance(spark):
    r = spark.range(1).select(X.haversine_km(F.lit(47.4647), F.lit(8.5492), F.lit(51.47), F.lit(-0.4543)).alias("d")).first()
    assert abs(r.d - 788.0) < 5.0   # Zurich – London Heathrow


def test_auc_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = [(round(rnd.random(), 2), rnd.random() < 0.4) for _ in range(400)]
    pos = [p for p, y in rows if y]
    neg = [p for p, y in rows if not y]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "p_late double, is_late boolean")
    assert abs(EV.auc(df, per_range=8).first().auc - brute) < 1e-12
    assert abs(EV.auc_by_group(df.withColumn("g", F.lit(1)), ["g"]).first().auc - brute) < 1e-12


def test_nl_number_format(spark):
    df = spark.createDataFrame([(323461.0,), (8.25,), (None,)], "x double")
    got = [r.t for r in df.select(X.nl_number("x", 1).alias("t")).collect()]
    assert got[0] == "323.461,0" and got[2] == "–"


def test_exact_quantiles_match_percentile(spark):
    import random
    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 300)) / 7,) for _ in range(2000)] + [(None,)]
    df = spark.createDataFrame(rows, "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    want = df.select(F.percentile("x", F.array(*[F.lit(p) for p in probs]))).first()[0]
    got = EV.exact_quantiles(df, "x", probs).first().q
    assert len(got) == len(probs) and all(abs(a - b) < 1e-9 for a, b in zip(got, want))


def test_hash_sample_equals_global_top_k(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    h = F.xxhash64(F.col("k"), F.lit(42))
    want = sorted(r.k for r in df.orderBy(h, "k").limit(100).collect())
    got = sorted(r.k for r in EV.hash_sample(df, "k", 100, 42).collect())
    assert got == want and len(got) == 100
    assert EV.hash_sample(df, "k", 10_000, 42).count() == 5000


def test_median_table_matches_percentile(spark):
    import random
    from punctuo.operators.quantiles import median_table
    rnd = random.Random(5)
    rows = [("hot", float(rnd.randint(-30, 90))) for _ in range(3000)]          # one hot group, many ties
    rows += [(f"g{i}", float(rnd.randint(0, 9))) for i in range(40) for _ in range(i % 4 + 1)]
    rows += [("nulls", None), ("one", 7.0), ("two", 1.0), ("two", 4.0)]
    df = spark.createDataFrame(rows, "k string, delay_min double")
    got = {r.k: r.median for r in median_table(df, ["k"], "delay_min").collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("delay_min").alias("m")).collect() if r.m is not None}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert got["two"] == 2.5 and "nulls" not in got


def test_sketch_options_run(spark):
    df = fact(spark, [("x", float(i)) for i in range(100)] + [("y", 3.0)]).withColumn("year", F.lit(2019)) \
        .withColumn("place_code", F.col("k"))
    s = {r.k: r for r in RP.summary(df, "k", exact=False).collect()}
    assert s["x"].n == 100 and abs(s["x"].median_delay - 49.5) <= 1.0
    h = RP.headline(df, exact=False).first()
    assert h.n == 101 and h.n_places == 2
    assert RP.by_year(df, exact=False).first().n_places == 2


def test_two_key_lookup_large_dimension_path_equals_broadcast_path(spark):
    from punctuo.config import DEFAULTS
    dim = spark.createDataFrame([
        (1, "Alpha", None, "AAAA", "AAA"), (2, "Alpha2", "Acity", "ZZZZ", "AAAA"),
        (3, "Beta", "Bcity", "BBBB", "BBB"), (4, "Beta-dup", "X", "BBBB", "B2")], PLACE)
    f = spark.createDataFrame([("AAAA",), ("BBB",), ("BBBB",), ("QQQ",), (None,), ("BBB",)], "code string")
    args = (f, dim, "code", "key_a", "key_b", ["name", "city"], ["place_id"], "name")
    small = sorted(map(tuple, LK.lookup_two_keys(*args).collect()), key=str)
    large = sorted(map(tuple, LK.lookup_two_keys(*args, params=DEFAULTS.with_(broadcast_max_rows=2)).collect()), key=str)
    assert small == large and len(large) == 6
