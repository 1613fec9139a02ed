"""Findings of a base year against plain pandas, report rounding, the text of a selection."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from punctuo.operators import reports as RP


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    gusts = {d: rnd.choice([None, 20.0, 35.0, 45.0, 70.0]) for d in range(40)}
    out = []
    for _ in range(3000):
        d = int(40 * rnd.random() ** 2)
        hour = rnd.choice([8, 17])
        out.append((dt.date(2019, 1, 1) + dt.timedelta(days=d), rnd.choice([2019, 2019, 2020]), hour, rnd.choice(["departure", "arrival", None]),
                    rnd.choice([30, 50, 70]), gusts[d], rnd.random() < 0.3, rnd.choice([True, False, False, None])))
    return out


SCHEMA = "day date, year int, hour int, direction string, hour_load int, wpgt double, frost boolean, is_late boolean"


def test_findings_of_a_year_equal_pandas(spark, rows):
    df = spark.createDataFrame([(*r[:6], r[0].day % 5 == 0, r[7]) for r in rows], SCHEMA)
    got = RP.fixed_findings(df, 2019).first().asDict()
    pdf = df.filter("year = 2019").toPandas()
    pdf["late"] = pdf["is_late"].map({True: 1.0, False: 0.0})
    pdf["n"] = pdf.groupby("day")["day"].transform("size")
    usual = pdf.drop_duplicates("day")["n"].median()
    days = pdf.groupby("day").agg(share=("late", "mean"), wpgt=("wpgt", "first"))
    out = pdf[pdf.direction == "departure"]
    want = {
        "late_pct_busy_hours": out[out.hour_load > 60].late.mean(), "late_pct_quiet_hours": out[out.hour_load <= 40].late.mean(),
        "storm_day_late_pct": days[days.wpgt >= 60].share.mean(), "calm_day_late_pct": days[days.wpgt < 30].share.mean(),
        "late_pct_busy_storm": pdf[(pdf.n > usual) & (pdf.wpgt >= 60)].late.mean(),
        "late_pct_quiet_calm": pdf[(pdf.n <= usual) & (pdf.wpgt < 40)].late.mean(),
        "late_pct_frost": pdf[pdf.frost].late.mean(), "late_pct_no_frost": pdf[~pdf.frost].late.mean()}
    assert got == {k: pytest.approx(100 * v) for k, v in want.items()}


def test_findings_of_a_year_without_rows(spark, rows):
    r = RP.fixed_findings(spark.createDataFrame(rows, SCHEMA), 1990).first()
    assert set(r.asDict().values()) == {None}


def test_report_rounding_takes_halves_to_even(spark):
    df = spark.createDataFrame([(0.25, 1.125), (0.35, 1.135), (-0.25, None), (2.5, 1e9 + 0.125)], "a double, b double")
    got = [tuple(r) for r in RP.report_round(df, {"a": 1, "b": 2}).collect()]
    assert got == [(0.2, 1.12), (0.4, 1.14), (-0.2, None), (2.5, 1000000000.12)]


def test_selection_text(spark):
    df = spark.range(1234).select(F.lit(2019).alias("year"), F.lit("departure").alias("direction"), F.lit("LX").alias("airline"), F.lit("A320").alias("aircraft"))
    assert RP.selection_text(df).first()[0] == "all years · both directions · airline (all) · type (all) · 1.234 flights"
    assert RP.selection_text(df, 2020, "arrival", ("LX", "KL"), ("A320",)).first()[0] == "2020 · arrival · airline LX, KL · type A320 · 0 flights"
